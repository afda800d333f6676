"""Bindings of the follow-up reports: message errors, ticket times, one-touch rate, daily fulfilment,
lane and carrier costs, MRR summary, outcomes by cohort, cycle times and responder load."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import commerce as cm
from ..operators import crm
from ..operators import marketing as mk
from ..operators import operations as op
from ..operators import revenue as rv
from ..operators import support as sp
from .common import finalize, load, sql_date, sql_ts

AS_OF = "2001-09-01"


def message_errors_daily(spark, d):
    e = load(spark, d, "events").select(
        "ts", "user_id", "event_type", F.get_json_object("props", "$.k").try_cast("int").alias("code"),
        F.when(F.col("value") >= 50, "failed").otherwise("undelivered").alias("status"))
    return finalize(mk.message_errors(e, "ts", "code", ["event_type"], "status", "user_id"))


def _tickets(spark, d):
    """Orders as tickets, their lines as messages: a returned line is a reply, its tax rate a rating."""
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    li = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_linenumber", "l_returnflag", "l_tax")
    last = li.groupBy("o_orderkey").agg(F.max("l_shipdate").alias("_last"))
    o = o.join(last, "o_orderkey", "left").withColumn("solved_at", F.when(F.col("o_orderstatus") == "F", F.col("_last"))).drop("_last")
    return o, li


def order_ticket_times(spark, d):
    o, li = _tickets(spark, d)
    # lines of one number may ship at one moment: the larger rating is then the latest
    li = li.withColumn("at", F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(secs=F.col("l_linenumber")))
    o = o.withColumns({"o_orderdate": F.col("o_orderdate").cast("timestamp"), "solved_at": F.col("solved_at").cast("timestamp")})
    return finalize(sp.ticket_times(o, li, "o_orderkey", "o_orderdate", "at", F.col("l_returnflag") == "R", "solved_at", rating="l_tax"))


def one_touch_by_month(spark, d):
    o, li = _tickets(spark, d)
    life = sp.ticket_lifecycle(o, li, "o_orderkey", "o_orderdate", "l_shipdate", F.col("l_returnflag") == "R")
    return finalize(sp.one_touch(life, ["o_orderpriority"], "reply_count", "solved_at"))


def fulfillment_by_day(spark, d):
    li = load(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_linestatus").alias("warehouse"),
        "l_shipdate", "l_quantity", "l_returnflag", (F.col("l_quantity") * 2).alias("label"),
        F.concat_ws("-", "l_orderkey", F.to_date("l_shipdate")).alias("shipment"))
    return finalize(cm.fulfillment_by_day(li, ["warehouse"], "l_shipdate", "shipment", "l_orderkey", "l_quantity", "label",
                                          F.col("l_returnflag") == "R"))


def _freight(spark, d):
    li = load(spark, d, "lineitem")
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_custkey")
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("to_nation"))
    s = load(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("from_nation"))
    j = li.join(o, "l_orderkey").join(c, "o_custkey").join(s, "l_suppkey")
    return j.select("from_nation", "to_nation", F.when(F.col("l_returnflag") != "R", F.col("l_linestatus")).alias("carrier"),
                    "o_orderdate", "l_shipdate", F.date_add(F.to_date("o_orderdate"), 60).alias("promised"),
                    F.when(F.col("l_discount") > 0, F.col("l_tax") * 100).alias("cost"), F.col("l_quantity").alias("weight"),
                    (F.col("l_returnflag") == "R").alias("cancelled"))


def lane_costs(spark, d):
    return finalize(cm.lane_costs(_freight(spark, d), ["from_nation", "to_nation"], "carrier", "o_orderdate", "cost", "weight",
                                  "l_shipdate", "promised", AS_OF))


def carrier_costs_by_month(spark, d):
    return finalize(cm.carrier_costs(_freight(spark, d), ["carrier"], "o_orderdate", "cost", "weight", F.col("cancelled"), AS_OF))


def mrr_summary(spark, d):
    o = load(spark, d, "orders").select("o_custkey", F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"), "o_totalprice")
    series = rv.mrr_time_series(o, "o_custkey", "month", "o_totalprice")
    return finalize(rv.mrr_summary(series, "month", F.col("o_custkey") % 3 == 0))


def outcomes_by_cohort(spark, d):
    o, _ = _tickets(spark, d)
    v = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    deals = o.join(v, "o_orderkey").withColumns({"o_orderdate": F.col("o_orderdate").cast("timestamp"),
                                                 "solved_at": F.col("solved_at").cast("timestamp")})
    return finalize(crm.outcomes_by_cohort(deals, "o_orderdate", ["o_orderpriority"], "o_orderstatus", "o_totalprice", "solved_at",
                                           won="F", lost="P", open_="O"))


def line_cycle_times(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("done"))
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("timestamp").alias("created"))
    j = li.join(o, "l_orderkey").withColumns({"started": F.col("created") + F.expr("INTERVAL 1 DAY") * F.col("l_linenumber"),
                                              "due": F.date_add(F.to_date("created"), 60)})
    out = op.cycle_times(j, "created", "started", "done", "due")
    return finalize(out.select("l_orderkey", "l_linenumber", "completed_date", "lead_time_days", "cycle_time_days",
                               "completed_after_due_date"))


def responder_load(spark, d):
    li = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_returnflag")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return finalize(op.responder_load(li, o, "o_orderkey", "l_suppkey", "l_returnflag", "o_orderdate",
                                      {"assigned": "N", "acknowledged": "A", "resolved": "R"}, F.col("o_orderpriority") == "1-URGENT"))


QUERIES = {f.__name__: f for f in (message_errors_daily, order_ticket_times, one_touch_by_month, fulfillment_by_day, lane_costs,
                                   carrier_costs_by_month, mrr_summary, outcomes_by_cohort, line_cycle_times, responder_load)}

_FREIGHT = """
WITH freight AS (
  SELECT s.s_nationkey AS from_nation, c.c_nationkey AS to_nation, IF(l.l_returnflag <> 'R', l.l_linestatus, NULL) AS carrier,
         CAST(o.o_orderdate AS DATE) AS shipped, CAST(l.l_shipdate AS DATE) AS delivered,
         IF(l.l_discount > 0, l.l_tax * 100, NULL) AS cost, l.l_quantity AS weight, l.l_returnflag = 'R' AS cancelled
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey)
"""
_SOLVED = """
WITH solved AS (SELECT o.o_orderkey, IF(o.o_orderstatus = 'F', MAX(l.l_shipdate), NULL) AS solved_at,
                       COUNT(l.l_orderkey) FILTER (l.l_returnflag = 'R') AS replies
                FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey, o.o_orderstatus)
"""

ORACLE = {
    "message_errors_daily": f"""
WITH e AS (SELECT CAST(ts AS DATE) AS day, event_type, user_id, value, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS code FROM events)
SELECT {sql_date('day')} AS date, event_type, code AS error_code, COUNT(*) AS messages,
       COUNT(*) FILTER (value >= 50) AS failed, COUNT(*) FILTER (value < 50 OR value IS NULL) AS undelivered,
       COUNT(DISTINCT user_id) AS distinct_recipients
FROM e WHERE code <> 0 GROUP BY day, event_type, code
""",
    "order_ticket_times": f"""
WITH m AS (SELECT l_orderkey, CAST(l_shipdate AS TIMESTAMP) + l_linenumber * INTERVAL 1 SECOND AS sent_at, l_returnflag, l_tax FROM lineitem),
g AS (SELECT l_orderkey, MIN(sent_at) FILTER (l_returnflag = 'R') AS first_reply_at, COUNT(*) FILTER (l_returnflag = 'R') AS reply_count,
             COUNT(*) AS message_count, MAX(sent_at) AS last_message_at, (MAX({{'at': sent_at, 'rating': l_tax}}) FILTER (l_tax IS NOT NULL)).rating AS latest_rating
      FROM m GROUP BY l_orderkey),
x AS (SELECT o.o_orderkey, CAST(o.o_orderdate AS TIMESTAMP) AS o_orderdate, o.o_orderstatus, o.o_orderpriority, g.*,
             IF(o.o_orderstatus = 'F', (SELECT MAX(CAST(l_shipdate AS TIMESTAMP)) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey), NULL) AS solved_at
      FROM orders o LEFT JOIN g ON g.l_orderkey = o.o_orderkey)
SELECT o_orderkey, {sql_ts('o_orderdate')} AS o_orderdate, o_orderstatus, o_orderpriority, {sql_ts('solved_at')} AS solved_at,
       {sql_ts('first_reply_at')} AS first_reply_at, IFNULL(reply_count, 0) AS reply_count, message_count,
       {sql_ts('last_message_at')} AS last_message_at, first_reply_at IS NOT NULL AS is_answered,
       IF(first_reply_at IS NULL, NULL, GREATEST(trunc((epoch_us(first_reply_at) - epoch_us(o_orderdate)) / 60000000)::BIGINT, 0)) AS first_response_minutes,
       IF(solved_at IS NULL, NULL, GREATEST(trunc((epoch_us(solved_at) - epoch_us(o_orderdate)) / 60000000)::BIGINT, 0)) AS resolution_minutes,
       latest_rating
FROM x
""",
    "one_touch_by_month": _SOLVED + f"""
SELECT {sql_date("date_trunc('month', solved_at)")} AS month, o_orderpriority, COUNT(*) AS solved, COUNT(*) FILTER (replies <= 1) AS one_touch,
       ROUND(COUNT(*) FILTER (replies <= 1) / COUNT(*), 6) AS one_touch_rate
FROM solved JOIN orders USING (o_orderkey) WHERE solved_at IS NOT NULL GROUP BY date_trunc('month', solved_at), o_orderpriority
""",
    "fulfillment_by_day": f"""
WITH l AS (SELECT *, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_shipdate IS NOT NULL),
cal AS (SELECT mode, CAST(unnest(generate_series(lo, (SELECT MAX(day) FROM l), INTERVAL 1 DAY)) AS DATE) AS day
        FROM (SELECT l_linestatus AS mode, MIN(day) AS lo FROM l GROUP BY ALL))
SELECT cal.mode AS warehouse, {sql_date('cal.day')} AS date, COUNT(DISTINCT (l.l_orderkey, l.day)) FILTER (l.l_orderkey IS NOT NULL) AS shipments,
       COUNT(DISTINCT l.l_orderkey) AS orders_shipped, IFNULL(SUM(l.l_quantity), 0) AS units_shipped,
       COUNT(l.l_orderkey) FILTER (l.l_returnflag <> 'R') AS labels, COUNT(l.l_orderkey) FILTER (l.l_returnflag = 'R') AS refunded_labels,
       ROUND(IFNULL(SUM(l.l_quantity * 2) FILTER (l.l_returnflag <> 'R'), 0.0), 2) AS label_cost
FROM cal LEFT JOIN l ON l.l_linestatus IS NOT DISTINCT FROM cal.mode AND l.day = cal.day GROUP BY cal.mode, cal.day
""",
    "lane_costs": _FREIGHT + f"""
SELECT from_nation, to_nation, IFNULL(carrier, '(unknown carrier)') AS carrier, {sql_date('MIN(shipped)')} AS first_shipment_date,
       {sql_date('MAX(shipped)')} AS last_shipment_date, COUNT(*) AS shipments,
       COUNT(*) FILTER (shipped >= DATE '{AS_OF}' - 90) AS shipments_last_90_days, SUM(weight) AS weight,
       ROUND(AVG(delivered - shipped), 4) AS avg_transit_days, ROUND(SUM(cost), 2) AS cost, ROUND(SUM(cost) / NULLIF(COUNT(cost), 0), 4) AS cost_per_shipment,
       ROUND(SUM(cost) FILTER (weight > 0) / SUM(weight) FILTER (weight > 0 AND cost IS NOT NULL), 4) AS cost_per_kg,
       ROUND(COUNT(*) FILTER (delivered <= shipped + 60) / NULLIF(COUNT(delivered), 0), 6) AS on_time_rate
FROM freight GROUP BY from_nation, to_nation, carrier
""",
    "carrier_costs_by_month": _FREIGHT + f"""
, cal AS (SELECT carrier, CAST(unnest(generate_series(lo, GREATEST(hi, DATE '{AS_OF}'), INTERVAL 1 MONTH)) AS DATE) AS month
          FROM (SELECT carrier, CAST(date_trunc('month', MIN(shipped)) AS DATE) AS lo, CAST(date_trunc('month', MAX(shipped)) AS DATE) AS hi
                FROM freight GROUP BY carrier)),
j AS (SELECT cal.carrier, cal.month, COUNT(*) FILTER (NOT cancelled) AS shipments, COUNT(*) FILTER (cancelled) AS cancelled_shipments,
             ROUND(IFNULL(SUM(cost), 0.0), 2) AS freight_cost, IFNULL(SUM(weight) FILTER (NOT cancelled), 0) AS weight
      FROM cal LEFT JOIN freight f ON f.carrier IS NOT DISTINCT FROM cal.carrier AND date_trunc('month', f.shipped) = cal.month GROUP BY ALL)
SELECT carrier, {sql_date('month')} AS month, shipments, cancelled_shipments, freight_cost, weight,
       ROUND(freight_cost / NULLIF(weight, 0), 4) AS cost_per_kg FROM j
""",
    "mrr_summary": f"""
WITH paid AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, SUM(o_totalprice) AS mrr FROM orders GROUP BY ALL),
span AS (SELECT o_custkey, MIN(month) AS lo, (SELECT MAX(month) FROM paid) AS hi FROM paid GROUP BY o_custkey),
cal AS (SELECT o_custkey, lo, hi, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM span),
filled AS (SELECT cal.*, p.mrr FROM cal ASOF JOIN paid p ON p.o_custkey = cal.o_custkey AND cal.month >= p.month),
step AS (SELECT a.o_custkey, a.month, a.lo, a.hi, a.mrr, a.mrr - b.mrr AS change FROM filled a
         LEFT JOIN filled b ON b.o_custkey = a.o_custkey AND b.month = a.month - INTERVAL 1 MONTH),
g AS (SELECT month, ROUND(IFNULL(SUM(mrr) FILTER (month = lo), 0.0), 2) AS new_mrr,
             ROUND(IFNULL(SUM(change) FILTER (change < 0), 0.0), 2) AS contraction_mrr,
             ROUND(IFNULL(SUM(-mrr) FILTER (month = hi AND o_custkey % 3 = 0), 0.0), 2) AS churn_mrr,
             ROUND(IFNULL(SUM(change) FILTER (change > 0), 0.0), 2) AS expansion_mrr FROM step GROUP BY month),
n AS (SELECT *, ROUND(new_mrr + contraction_mrr + churn_mrr + expansion_mrr, 2) AS net_new_mrr FROM g)
SELECT {sql_date('n.month')} AS month, new_mrr, contraction_mrr, churn_mrr, expansion_mrr, net_new_mrr,
       ROUND((SELECT SUM(x.net_new_mrr) FROM n x WHERE x.month <= n.month), 2) AS mrr_total FROM n
""",
    "outcomes_by_cohort": _SOLVED + f"""
SELECT {sql_date("date_trunc('month', o_orderdate)")} AS created_month, o_orderpriority, COUNT(*) AS deals,
       COUNT(*) FILTER (o_orderstatus = 'O') AS open_deals, COUNT(*) FILTER (o_orderstatus = 'F') AS won_deals,
       COUNT(*) FILTER (o_orderstatus = 'P') AS lost_deals, ROUND(SUM(o_totalprice), 2) AS total_value,
       ROUND(IFNULL(SUM(o_totalprice) FILTER (o_orderstatus = 'F'), 0.0), 2) AS won_value,
       ROUND(IFNULL(SUM(o_totalprice) FILTER (o_orderstatus = 'O'), 0.0), 2) AS open_value,
       ROUND(AVG(trunc((epoch_us(CAST(solved_at AS TIMESTAMP)) - epoch_us(CAST(o_orderdate AS TIMESTAMP))) / 3600000000) / 24.0), 4) AS avg_days_to_win,
       ROUND(COUNT(*) FILTER (o_orderstatus = 'F') / NULLIF(COUNT(*) FILTER (o_orderstatus IN ('F', 'P')), 0), 6) AS win_rate
FROM orders JOIN solved USING (o_orderkey) WHERE o_orderdate IS NOT NULL GROUP BY date_trunc('month', o_orderdate), o_orderpriority
""",
    "line_cycle_times": f"""
WITH x AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS TIMESTAMP) AS done, CAST(o_orderdate AS TIMESTAMP) AS created
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate IS NOT NULL)
SELECT l_orderkey, l_linenumber, {sql_date('done')} AS completed_date,
       ROUND(trunc((epoch_us(done) - epoch_us(created)) / 1000000) / 86400.0, 2) AS lead_time_days,
       ROUND(trunc((epoch_us(done) - epoch_us(created)) / 1000000 - 86400 * l_linenumber) / 86400.0, 2) AS cycle_time_days,
       CAST(done AS DATE) > CAST(created AS DATE) + 60 AS completed_after_due_date
FROM x
""",
    "responder_load": f"""
SELECT {sql_date('o_orderdate')} AS date, l_suppkey, COUNT(DISTINCT o_orderkey) FILTER (l_returnflag = 'N') AS incidents_assigned,
       COUNT(DISTINCT o_orderkey) FILTER (l_returnflag = 'A') AS incidents_acknowledged,
       COUNT(DISTINCT o_orderkey) FILTER (l_returnflag = 'R') AS incidents_resolved,
       COUNT(DISTINCT o_orderkey) FILTER (l_returnflag = 'N' AND o_orderpriority = '1-URGENT') AS high_urgency_incidents
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY CAST(o_orderdate AS DATE), l_suppkey, {sql_date('o_orderdate')}
""",
}
