"""Activity reports. Binding: a user is a rep / host / booker whose event types are
activity kinds; a signup opens a booking whose reschedule chain is the user's later
events; an error event is an incident; a conversation is a call (speakers = roles);
a customer is an account and an employee (employed from the first order until 180
days after the last; org = priority of the latest order at the month end, an as-of join); a supplier is an agent."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rnd
from ..operators import crm
from ..operators import operations as op
from ..operators import support as sp
from ..operators.windows import seq_neighbors
from ..session import cut_lineage, tasks_for
from .common import finalize, load, sql_date

ACTIVITY_KINDS = ["signup", "view", "click", "purchase", "error"]
REP_END = "2024-01-31"
HEADCOUNT_AS_OF = "2002-06-30"
RESPONSES_AS_OF = "2024-01-31"
SPEAKERS = ["user", "assistant", "system"]


def rep_activity(spark, d):
    e = load(spark, d, "events")
    return finalize(crm.rep_activity_by_kind(e, "user_id", "ts", "event_type", ACTIVITY_KINDS, end=REP_END))


def account_360(spark, d):
    c = load(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    o = load(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    li = load(spark, d, "lineitem").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "c_custkey"), "l_orderkey")
    facts = {
        "orders": (o, {"orders": F.count(F.lit(1)), "open_orders": F.count_if(F.col("o_orderstatus") == "O"),
                       "order_value": rnd(F.sum("o_totalprice"), 2),
                       "last_order_date": F.max(F.to_date("o_orderdate"))}),
        "lines": (li, {"lines": F.count(F.lit(1)), "returned_lines": F.count_if(F.col("l_returnflag") == "R"),
                       "last_ship_date": F.max(F.to_date("l_shipdate"))}),
    }
    return finalize(crm.account_360(c, "c_custkey", facts))


def bookings_by_source(spark, d):
    e = load(spark, d, "events").select("user_id", "event_id", "ts", "event_type",
                                        F.get_json_object("props", "$.k").alias("source"))
    b = seq_neighbors(e, "user_id", ["ts", "event_id"], ["event_id"], F.date_trunc("hour", "ts"), prev_prefix=None)
    b = cut_lineage(b)  # bookings feed the chain walk, the start rows and the final rows: read the events once
    outcome = (F.when(F.col("event_type") == "error", "canceled").when(F.col("event_type") == "purchase", "completed")
               .otherwise("no_show"))
    return finalize(crm.bookings_by_source(b, "event_id", "next_event_id", F.col("event_type") == "signup", "ts",
                                           "source", outcome, "ts"))


def meetings_daily(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    first = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("held_at"))
    return finalize(crm.meetings_daily(o.join(first, "o_orderkey", "left"), ["o_orderpriority"], "o_orderdate", "held_at"))


def call_analytics(spark, d):
    return crm.call_analytics(load(spark, d, "conversations"), "conv_id", "role", "text", SPEAKERS)


def agent_performance(spark, d):
    li = load(spark, d, "lineitem").withColumn("month", F.to_date(F.date_trunc("month", "l_shipdate")))
    # both facts come from lineitem: one roll-up with a conditional count (one scan)
    facts = {"lines": (li, {"lines_handled": F.count(F.lit(1)), "units_handled": F.sum("l_quantity"),
                            "returns": F.count_if(F.col("l_returnflag") == "R")})}
    return finalize(sp.agent_performance(facts, "l_suppkey", "month"))


def response_volume(spark, d):
    e = load(spark, d, "events")
    return finalize(sp.response_volume(e, "event_type", "ts", F.col("value") >= 10, "value", RESPONSES_AS_OF))


def incident_response(spark, d):
    e = load(spark, d, "events")
    return finalize(op.incident_response(e, "user_id", "ts", "event_type", "error", ["view", "click"], ["purchase"],
                                         order=["event_id"]))


def headcount_monthly(spark, d):
    o = load(spark, d, "orders")
    n = tasks_for(o)
    # org history: the priority of the person's latest order (one row per person and day); spans come from the same rows
    days = o.select("o_custkey", F.to_date("o_orderdate").alias("changed_on"), "o_orderdate", "o_orderpriority").repartition(
        n, "o_custkey", "changed_on").groupBy("o_custkey", "changed_on").agg(
        F.max("o_orderpriority").alias("org"), F.min("o_orderdate").alias("_first"), F.max("o_orderdate").alias("_last"))
    spans = days.repartition(n, "o_custkey").groupBy("o_custkey").agg(F.min("_first").alias("start_date"), F.max("_last").alias("_last"))
    spans = spans.withColumn("end_date", F.date_add(F.to_date("_last"), 180))
    spans = spans.withColumn("end_date", F.when(F.col("end_date") <= F.lit(HEADCOUNT_AS_OF).cast("date"), F.col("end_date")))
    hist = days.select("o_custkey", "changed_on", "org")
    return finalize(op.headcount(spans, "o_custkey", "org", "start_date", "end_date", HEADCOUNT_AS_OF,
                                 history=hist, hist_ts="changed_on", tasks=n))


QUERIES = {
    "rep_activity": rep_activity,
    "account_360": account_360,
    "bookings_by_source": bookings_by_source,
    "meetings_daily": meetings_daily,
    "call_analytics": call_analytics,
    "agent_performance": agent_performance,
    "response_volume": response_volume,
    "incident_response": incident_response,
    "headcount_monthly": headcount_monthly,
}

ORACLE = {
    "rep_activity": f"""
WITH g AS (SELECT user_id, CAST(ts AS DATE) AS date,
                  {", ".join(f"COUNT(*) FILTER (WHERE event_type = '{k}') AS {k}" for k in ACTIVITY_KINDS)}
           FROM events WHERE event_type IN ({", ".join(f"'{k}'" for k in ACTIVITY_KINDS)}) GROUP BY 1, 2),
f AS (SELECT user_id, MIN(date) AS s FROM g GROUP BY 1),
grid AS (SELECT user_id, CAST(unnest(generate_series(s, GREATEST(DATE '{REP_END}', s), INTERVAL 1 DAY)) AS DATE) AS date FROM f),
j AS (SELECT grid.user_id, grid.date, {", ".join(f"COALESCE(g.{k}, 0) AS {k}" for k in ACTIVITY_KINDS)}
      FROM grid LEFT JOIN g ON g.user_id IS NOT DISTINCT FROM grid.user_id AND g.date = grid.date)
SELECT user_id, {sql_date('date')} AS date, {", ".join(ACTIVITY_KINDS)}, {" + ".join(ACTIVITY_KINDS)} AS total_activities FROM j
""",
    "account_360": f"""
WITH o AS (SELECT o_custkey, COUNT(*) AS orders, COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS open_orders,
                  ROUND(SUM(o_totalprice), 2) AS order_value, MAX(CAST(o_orderdate AS DATE)) AS last_order_date
           FROM orders GROUP BY 1),
l AS (SELECT o.o_custkey, COUNT(*) AS lines, COUNT(*) FILTER (WHERE l.l_returnflag = 'R') AS returned_lines,
             MAX(CAST(l.l_shipdate AS DATE)) AS last_ship_date
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1)
SELECT c.c_custkey, c.c_name, c.c_mktsegment, o.orders, o.open_orders, o.order_value, {sql_date('o.last_order_date')}
         AS last_order_date, l.lines, l.returned_lines, {sql_date('l.last_ship_date')} AS last_ship_date
FROM customer c LEFT JOIN o ON o.o_custkey = c.c_custkey LEFT JOIN l ON l.o_custkey = c.c_custkey
""",
    "bookings_by_source": f"""
WITH o AS (SELECT event_id, user_id, ts, event_type, json_extract_string(props, '$.k') AS source,
                  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
                  COUNT(*) OVER (PARTITION BY user_id) AS n FROM events),
s AS (SELECT o.*, n - rn AS hops FROM o WHERE event_type = 'signup'),
f AS (SELECT s.ts AS booked, COALESCE(s.source, '(not set)') AS source, s.hops, e.ts AS fts,
             CASE WHEN e.event_type = 'error' THEN 'canceled' WHEN e.event_type = 'purchase' THEN 'completed'
                  ELSE 'no_show' END AS final_outcome
      FROM s JOIN o e ON e.user_id IS NOT DISTINCT FROM s.user_id AND e.rn = s.rn + s.hops)
SELECT {sql_date("date_trunc('month', booked)")} AS booking_month, source, final_outcome, COUNT(*) AS bookings,
       CAST(SUM(hops) AS BIGINT) AS reschedules,
       ROUND(AVG(((epoch_us(fts) - epoch_us(booked)) // 60000000) / 60.0), 4) AS avg_lead_time_hours
FROM f GROUP BY ALL
""",
    "meetings_daily": f"""
WITH f AS (SELECT l_orderkey, MIN(l_shipdate) AS held_at FROM lineitem GROUP BY 1),
t AS (SELECT o.o_orderpriority, o.o_orderdate, f.held_at FROM orders o LEFT JOIN f ON f.l_orderkey = o.o_orderkey),
ev AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, 'b' AS m FROM t WHERE o_orderdate IS NOT NULL
       UNION ALL SELECT o_orderpriority, CAST(held_at AS DATE), 'h' FROM t WHERE held_at IS NOT NULL)
SELECT o_orderpriority, {sql_date('date')} AS date, COUNT(*) FILTER (WHERE m = 'b') AS meetings_booked,
       COUNT(*) FILTER (WHERE m = 'h') AS meetings_held FROM ev GROUP BY o_orderpriority, date
""",
    "call_analytics": f"""
WITH g AS (SELECT conv_id, COUNT(*) AS turns, CAST(SUM(length(text)) AS BIGINT) AS total_chars,
                  {", ".join(f"CAST(SUM(CASE WHEN role = '{s}' THEN length(text) ELSE 0 END) AS BIGINT) AS {s}_chars" for s in SPEAKERS)},
                  COUNT(*) FILTER (WHERE contains(text, '?')) AS questions, CAST(MAX(length(text)) AS INTEGER) AS longest_turn_chars
           FROM conversations GROUP BY 1)
SELECT *, {", ".join(f"ROUND({s}_chars::DOUBLE / NULLIF(total_chars, 0), 6) AS {s}_talk_share" for s in SPEAKERS)} FROM g
""",
    "agent_performance": f"""
WITH l AS (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_quantity, l_returnflag FROM lineitem),
h AS (SELECT l_suppkey, month, COUNT(*) AS lines_handled, SUM(l_quantity) AS units_handled FROM l GROUP BY 1, 2),
r AS (SELECT l_suppkey, month, COUNT(*) AS returns FROM l WHERE l_returnflag = 'R' GROUP BY 1, 2),
k AS (SELECT l_suppkey, month FROM h UNION SELECT l_suppkey, month FROM r)
SELECT k.l_suppkey, {sql_date('k.month')} AS month, COALESCE(h.lines_handled, 0) AS lines_handled,
       COALESCE(h.units_handled, 0) AS units_handled, COALESCE(r.returns, 0) AS returns
FROM k LEFT JOIN h USING (l_suppkey, month) LEFT JOIN r USING (l_suppkey, month)
""",
    "response_volume": f"""
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS date, COUNT(*) AS responses, COUNT(*) FILTER (WHERE value >= 10) AS completed,
                  ROUND(quantile_cont(value, 0.5), 4) AS median_duration FROM events GROUP BY 1, 2),
f AS (SELECT event_type, MIN(date) AS s FROM d GROUP BY 1),
grid AS (SELECT event_type, CAST(unnest(generate_series(s, GREATEST(DATE '{RESPONSES_AS_OF}', s), INTERVAL 1 DAY)) AS DATE)
           AS date FROM f),
j AS (SELECT grid.event_type, grid.date, COALESCE(d.responses, 0) AS responses, COALESCE(d.completed, 0) AS completed,
             d.median_duration FROM grid LEFT JOIN d USING (event_type, date))
SELECT event_type, {sql_date('date')} AS date, responses, completed, median_duration,
       ROUND(completed::DOUBLE / NULLIF(responses, 0), 6) AS completion_rate FROM j
""",
    "incident_response": f"""
WITH w AS (SELECT *, MIN(CASE WHEN event_type IN ('view', 'click') THEN ts END) OVER x AS ack,
                  MIN(CASE WHEN event_type IN ('purchase') THEN ts END) OVER x AS res
           FROM events WINDOW x AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT {sql_date('CAST(ts AS DATE)')} AS date, COUNT(*) AS incidents,
       ROUND(AVG((epoch_us(ack) - epoch_us(ts)) // 60000000), 4) AS mtta_minutes,
       ROUND(AVG((epoch_us(res) - epoch_us(ts)) // 60000000), 4) AS mttr_minutes,
       COUNT(*) FILTER (WHERE res IS NULL) AS unresolved
FROM w WHERE event_type = 'error' GROUP BY CAST(ts AS DATE)
""",
    "headcount_monthly": f"""
WITH s AS (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS st, CAST(MAX(o_orderdate) AS DATE) + INTERVAL 180 DAY AS e0
           FROM orders GROUP BY 1),
p AS (SELECT o_custkey, st, CASE WHEN e0 <= DATE '{HEADCOUNT_AS_OF}' THEN CAST(e0 AS DATE) END AS en FROM s),
ex AS (SELECT p.*, CAST(unnest(generate_series(CAST(date_trunc('month', st) AS DATE),
                  CAST(date_trunc('month', LEAST(COALESCE(en + INTERVAL 1 MONTH, DATE '{HEADCOUNT_AS_OF}'), DATE '{HEADCOUNT_AS_OF}')) AS DATE),
                  INTERVAL 1 MONTH)) AS DATE) AS month FROM p),
r AS (SELECT *, LEAST(last_day(month), COALESCE(en, last_day(month))) AS ref FROM ex),
h AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS eff, MAX(o_orderpriority) AS org FROM orders GROUP BY 1, 2),
o AS (SELECT r.o_custkey, r.month, arg_max(h.org, h.eff) AS org
      FROM r LEFT JOIN h ON h.o_custkey = r.o_custkey AND h.eff <= r.ref GROUP BY 1, 2),
x AS (SELECT r.*, o.org FROM r JOIN o ON o.o_custkey = r.o_custkey AND o.month = r.month),
g AS (SELECT month, org,
             COUNT(*) FILTER (WHERE st <= month - INTERVAL 1 DAY AND (en IS NULL OR en > month - INTERVAL 1 DAY)) AS headcount_start,
             COUNT(*) FILTER (WHERE st <= last_day(month) AND (en IS NULL OR en > last_day(month))) AS headcount_end,
             COUNT(*) FILTER (WHERE date_trunc('month', st) = month) AS hires,
             COUNT(*) FILTER (WHERE date_trunc('month', en) = month) AS leavers FROM x GROUP BY 1, 2)
SELECT {sql_date('month')} AS month, org, headcount_start, headcount_end, hires, leavers,
       ROUND(leavers / NULLIF((headcount_start + headcount_end) / 2.0, 0), 6) AS turnover_rate FROM g
""",
}
