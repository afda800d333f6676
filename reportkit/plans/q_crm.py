"""CRM reports. Binding: a user's event types are deal stages; an order is a deal
(owner = priority; won when fulfilled, lost when partially filled, closed on its
last ship day)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import rnd

from ..operators import crm
from .common import finalize, load, sql_date, sql_ts
from .q_support import _order_tickets

# Stage order used for the moved-backwards flag.
STAGE_ORDER = {"error": 0, "signup": 1, "view": 2, "click": 3, "purchase": 4}
STAGE_AS_OF = "2024-02-01 00:00:00"
FLOW_AS_OF = "2002-01-01"
SNAPSHOT_AS_OF = "2001-09-01"


def stage_history(spark, d):
    e = load(spark, d, "events").select("user_id", "event_id", "ts", F.col("event_type").alias("stage"))
    h = crm.stage_history(e, "user_id", "stage", "ts", STAGE_AS_OF, STAGE_ORDER, tiebreak="event_id")
    return finalize(h.select("user_id", "stage", "entered_at", "exited_at", "next_stage", "hours_in_stage",
                             "is_current", "moved_backwards"))


def _deals(spark, d):
    t = _order_tickets(spark, d)
    return t.withColumns({"won_at": F.when(F.col("o_orderstatus") == "F", F.col("last_ship")),
                          "lost_at": F.when(F.col("o_orderstatus") == "P", F.col("last_ship"))})


def deal_flow_by_month(spark, d):
    return finalize(crm.flow_by_period(_deals(spark, d), "o_orderdate", "won_at", "lost_at", ["o_orderpriority"],
                                       "month", FLOW_AS_OF))


def orders_by_nation(spark, d):
    o = load(spark, d, "orders").select("o_custkey", "o_totalprice")
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = load(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return crm.count_by(o.join(c, "o_custkey"), ["c_nationkey"], n, "c_nationkey", measure="o_totalprice")


def open_pipeline(spark, d):
    o = load(spark, d, "orders")
    return crm.snapshot_by_stage(o, "o_orderpriority", "o_totalprice", "o_orderdate",
                                 F.col("o_orderstatus") == "O", SNAPSHOT_AS_OF)


def deal_outcomes(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return crm.deal_pipeline(o, "o_orderstatus", ["F"], ["P"], "o_totalprice")


def segment_order_share(spark, d):
    from ..operators.events import weighted_shares
    c = load(spark, d, "customer")
    per = c.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("_n"))
    shares = per.withColumn("customer_share", F.col("_n") / F.sum("_n").over(Window.partitionBy("c_nationkey"))).drop("_n")
    o = load(spark, d, "orders").join(c.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    vol = o.groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("double").alias("orders"))
    out = weighted_shares(shares, vol, "c_nationkey", ["c_mktsegment"], "customer_share", "orders")
    return out.withColumns({"customer_share": rnd("customer_share", 6), "estimated_volume": rnd("estimated_volume", 4)})


QUERIES = {
    "segment_order_share": segment_order_share,
    "stage_history": stage_history,
    "deal_flow_by_month": deal_flow_by_month,
    "orders_by_nation": orders_by_nation,
    "open_pipeline": open_pipeline,
    "deal_outcomes": deal_outcomes,
}

_rank = "CASE stage " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in STAGE_ORDER.items()) + " END"

ORACLE = {
    "segment_order_share": """
WITH per AS (SELECT c_nationkey, c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1, 2),
sh AS (SELECT c_nationkey, c_mktsegment, n::DOUBLE / SUM(n) OVER (PARTITION BY c_nationkey) AS s FROM per),
v AS (SELECT c.c_nationkey, CAST(COUNT(*) AS DOUBLE) AS orders FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
      GROUP BY 1),
j AS (SELECT sh.c_nationkey, sh.c_mktsegment, sh.s, v.orders, sh.s * v.orders AS ev
      FROM sh JOIN v ON v.c_nationkey IS NOT DISTINCT FROM sh.c_nationkey)
SELECT c_nationkey, c_mktsegment, ROUND(s, 6) AS customer_share, orders, ROUND(ev, 4) AS estimated_volume,
       ROUND(ev / NULLIF(SUM(ev) OVER (PARTITION BY c_mktsegment), 0), 6) AS share_of_total FROM j
""",
    "stage_history": f"""
WITH e AS (SELECT user_id, event_id, ts, event_type AS stage FROM events WHERE event_type IS NOT NULL),
c AS (SELECT *, LAG(stage) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM e),
k AS (SELECT * FROM c WHERE p IS NULL OR p <> stage),
s AS (SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS exited_at,
             LEAD(stage) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_stage,
             LEAD({_rank}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_rank, {_rank} AS rnk FROM k)
SELECT user_id, stage, {sql_ts('ts')} AS entered_at, {sql_ts('exited_at')} AS exited_at,
       ROUND(((epoch_us(COALESCE(exited_at, TIMESTAMP '{STAGE_AS_OF}')) - epoch_us(ts)) // 60000000) / 60.0, 4) AS hours_in_stage,
       next_stage, exited_at IS NULL AS is_current, COALESCE(next_rank < rnk, FALSE) AS moved_backwards
FROM s
""",
    "deal_flow_by_month": f"""
WITH s AS (SELECT l_orderkey, MAX(l_shipdate) AS last_ship FROM lineitem GROUP BY 1),
t AS (SELECT o.*, CASE WHEN o_orderstatus = 'F' THEN s.last_ship END AS won_at,
             CASE WHEN o_orderstatus = 'P' THEN s.last_ship END AS lost_at
      FROM orders o LEFT JOIN s ON s.l_orderkey = o.o_orderkey),
ev AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, 'created' AS m FROM t
       WHERE o_orderdate IS NOT NULL
       UNION ALL SELECT o_orderpriority, CAST(date_trunc('month', won_at) AS DATE), 'won' FROM t WHERE won_at IS NOT NULL
       UNION ALL SELECT o_orderpriority, CAST(date_trunc('month', lost_at) AS DATE), 'lost' FROM t WHERE lost_at IS NOT NULL),
g AS (SELECT o_orderpriority, month, COUNT(*) FILTER (WHERE m = 'created') AS created,
             COUNT(*) FILTER (WHERE m = 'won') AS won, COUNT(*) FILTER (WHERE m = 'lost') AS lost FROM ev GROUP BY 1, 2),
f AS (SELECT o_orderpriority, MIN(month) AS s FROM g GROUP BY 1),
grid AS (SELECT o_orderpriority,
                CAST(unnest(generate_series(s, GREATEST(DATE '{FLOW_AS_OF}', s), INTERVAL 1 MONTH)) AS DATE) AS month FROM f)
SELECT grid.o_orderpriority, {sql_date('grid.month')} AS month, COALESCE(g.created, 0) AS created, COALESCE(g.won, 0) AS won,
       COALESCE(g.lost, 0) AS lost,
       ROUND(COALESCE(g.won, 0)::DOUBLE / NULLIF(COALESCE(g.won, 0) + COALESCE(g.lost, 0), 0), 6) AS win_rate
FROM grid LEFT JOIN g USING (o_orderpriority, month)
""",
    "orders_by_nation": """
WITH g AS (SELECT c.c_nationkey, COUNT(*) AS record_count, ROUND(SUM(o.o_totalprice), 2) AS total_o_totalprice
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1)
SELECT g.*, n.n_name FROM g LEFT JOIN nation n ON n.n_nationkey = g.c_nationkey
""",
    "open_pipeline": f"""
SELECT o_orderpriority, COUNT(*) AS open_deals, ROUND(SUM(o_totalprice), 2) AS open_value,
       ROUND(AVG(date_diff('day', CAST(o_orderdate AS DATE), DATE '{SNAPSHOT_AS_OF}')), 4) AS avg_age_days,
       CAST(MAX(date_diff('day', CAST(o_orderdate AS DATE), DATE '{SNAPSHOT_AS_OF}')) AS INTEGER) AS max_age_days
FROM orders WHERE o_orderstatus = 'O' GROUP BY 1
""",
    "deal_outcomes": """
SELECT o_orderkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderstatus IN ('F') THEN 'won' WHEN o_orderstatus IN ('P') THEN 'lost' ELSE 'open' END AS outcome,
       ROUND(o_totalprice * CASE WHEN o_orderstatus = 'F' THEN 1.0 WHEN o_orderstatus = 'P' THEN 0.0 ELSE 0.5 END, 2)
         AS weighted_amount
FROM orders
""",
}
