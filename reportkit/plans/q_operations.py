"""Operations reports. Binding: open orders are work items (due 30 days after the
order day, owner segment = customer market segment); fulfilled orders complete on
their last ship day; customer -> nation -> region is the area tree."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import operations as op
from ..operators.timegrid import flatten_tree
from ..functions.columns import rnd
from .common import finalize, load, sql_date
from .q_support import _order_tickets

WORKLOAD_AS_OF = "2001-07-01"


def open_workload(spark, d):
    o = load(spark, d, "orders").withColumn("due_date", F.date_add(F.to_date("o_orderdate"), 30))
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return op.workload(o.join(c, "o_custkey"), ["c_mktsegment"], "due_date", F.col("o_orderstatus") == "O", WORKLOAD_AS_OF)


def completion_stats(spark, d):
    t = _order_tickets(spark, d).withColumn("due_date", F.date_add(F.to_date("o_orderdate"), 60))
    return finalize(op.completion_stats(t, ["o_orderpriority"], "o_orderdate", "closed_at", "due_date"))


def line_flow_daily(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linestatus", "l_shipdate")
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return finalize(op.flow_by_day(li.join(o, "l_orderkey"), {"o_orderdate": "lines_ordered",
                                                              "l_shipdate": "lines_shipped"}, ["l_linestatus"]))


def area_tree(spark, d):
    r = load(spark, d, "region")
    n = load(spark, d, "nation")
    c = load(spark, d, "customer")
    nodes = (r.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("id"),
                      F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("name"))
             .unionByName(n.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"),
                                   F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent_id"),
                                   F.col("n_name").alias("name")))
             .unionByName(c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"),
                                   F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("parent_id"),
                                   F.col("c_name").alias("name"))))
    return flatten_tree(nodes, "id", "parent_id", "name")


def region_revenue_month(spark, d):
    o = load(spark, d, "orders")
    facts = o.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("node"),
                     F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"), "o_totalprice")
    return finalize(op.area_month(facts, area_tree(spark, d), "node", "month", "o_totalprice"))


# Fixed value: loaded labour cost per hour in the labour-vs-sales binding.
HOURLY_COST = 20.0


def labour_vs_sales(spark, d):
    o = load(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        rnd(F.sum("o_totalprice"), 2).alias("sales"))
    li = load(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").alias("labour_hours"), rnd(F.sum(F.col("l_quantity") * HOURLY_COST), 2).alias("labour_cost"))
    return finalize(op.labour_vs_sales(o, li, "date", "sales", "labour_cost", "labour_hours"))


def budget_vs_actual(spark, d):
    o = load(spark, d, "orders")
    budget = (o.groupBy("o_orderpriority", F.trunc(F.to_date("o_orderdate"), "month").alias("period_start"))
              .agg((F.count(F.lit(1)) * 150000.0).alias("budget"))
              .withColumn("period_end", F.last_day("period_start")))
    out = op.budget_vs_actual(budget, o, "o_orderpriority", "period_start", "period_end", "o_orderdate",
                              "o_totalprice", "budget")
    return finalize(out)


QUERIES = {
    "labour_vs_sales": labour_vs_sales,
    "budget_vs_actual": budget_vs_actual,
    "open_workload": open_workload,
    "completion_stats": completion_stats,
    "line_flow_daily": line_flow_daily,
    "area_tree": area_tree,
    "region_revenue_month": region_revenue_month,
}

_TREE = """
WITH RECURSIVE nodes AS (
  SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS name FROM region
  UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR), n_name FROM nation
  UNION ALL SELECT 'C' || CAST(c_custkey AS VARCHAR), 'N' || CAST(c_nationkey AS VARCHAR), c_name FROM customer),
walk AS (
  SELECT id AS node_id, parent_id AS nxt, id AS root_id, [name] AS path, 1 AS depth FROM nodes
  UNION ALL
  SELECT w.node_id, n.parent_id, n.id, list_prepend(n.name, w.path), w.depth + 1
  FROM walk w JOIN nodes n ON n.id = w.nxt),
deepest AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY node_id ORDER BY depth DESC) AS rn FROM walk)
"""

ORACLE = {
    "labour_vs_sales": f"""
WITH s AS (SELECT CAST(o_orderdate AS DATE) AS date, ROUND(SUM(o_totalprice), 2) AS sales FROM orders GROUP BY 1),
l AS (SELECT CAST(l_shipdate AS DATE) AS date, SUM(l_quantity) AS labour_hours, ROUND(SUM(l_quantity * 20.0), 2) AS labour_cost
      FROM lineitem GROUP BY 1),
m AS (SELECT date, COALESCE(sales, 0) AS sales, COALESCE(labour_hours, 0) AS labour_hours,
             COALESCE(labour_cost, 0) AS labour_cost FROM s FULL JOIN l USING (date))
SELECT {sql_date('date')} AS date, sales, labour_hours, labour_cost,
       ROUND(100.0 * labour_cost / NULLIF(sales, 0), 4) AS labour_pct,
       ROUND(sales / NULLIF(labour_hours, 0), 4) AS sales_per_labour_hour FROM m
""",
    "budget_vs_actual": f"""
WITH b AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start,
                  CAST(COUNT(*) * 150000.0 AS DOUBLE) AS budget FROM orders GROUP BY 1, 2),
a AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, SUM(o_totalprice) AS v FROM orders GROUP BY 1, 2),
s AS (SELECT b.o_orderpriority, b.period_start, SUM(a.v) AS actual FROM b JOIN a ON a.o_orderpriority = b.o_orderpriority
      AND a.day >= b.period_start AND a.day <= last_day(b.period_start) GROUP BY 1, 2)
SELECT b.o_orderpriority, {sql_date('b.period_start')} AS period_start, b.budget,
       {sql_date('last_day(b.period_start)')} AS period_end, ROUND(COALESCE(s.actual, 0.0), 2) AS actual,
       ROUND(ROUND(COALESCE(s.actual, 0.0), 2) - b.budget, 2) AS variance,
       ROUND((ROUND(COALESCE(s.actual, 0.0), 2) - b.budget) / NULLIF(b.budget, 0), 6) AS variance_pct
FROM b LEFT JOIN s ON s.o_orderpriority = b.o_orderpriority AND s.period_start = b.period_start
""",
    "open_workload": f"""
SELECT c.c_mktsegment, COUNT(*) AS open_items,
       COUNT(*) FILTER (WHERE CAST(o.o_orderdate AS DATE) + INTERVAL 30 DAY < DATE '{WORKLOAD_AS_OF}') AS overdue_items,
       COUNT(*) FILTER (WHERE CAST(o.o_orderdate AS DATE) + INTERVAL 30 DAY >= DATE '{WORKLOAD_AS_OF}'
                        AND CAST(o.o_orderdate AS DATE) + INTERVAL 30 DAY <= DATE '{WORKLOAD_AS_OF}' + INTERVAL 7 DAY)
         AS due_soon_items,
       COUNT(*) FILTER (WHERE o.o_orderdate IS NULL) AS no_due_date_items
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey WHERE o.o_orderstatus = 'O' GROUP BY 1
""",
    "completion_stats": f"""
WITH s AS (SELECT l_orderkey, MAX(l_shipdate) AS last_ship FROM lineitem GROUP BY 1),
t AS (SELECT o.*, CASE WHEN o.o_orderstatus = 'F' THEN s.last_ship END AS closed_at
      FROM orders o LEFT JOIN s ON s.l_orderkey = o.o_orderkey),
g AS (SELECT CAST(closed_at AS DATE) AS date, o_orderpriority, COUNT(*) AS completed,
             COUNT(*) FILTER (WHERE CAST(closed_at AS DATE) <= CAST(o_orderdate AS DATE) + INTERVAL 60 DAY) AS completed_on_time,
             ROUND(AVG(date_diff('day', CAST(o_orderdate AS DATE), CAST(closed_at AS DATE))), 4) AS avg_days_to_complete
      FROM t WHERE closed_at IS NOT NULL GROUP BY 1, 2)
SELECT {sql_date('date')} AS date, o_orderpriority, completed, completed_on_time, avg_days_to_complete,
       ROUND(completed_on_time::DOUBLE / NULLIF(completed, 0), 6) AS on_time_rate FROM g
""",
    "line_flow_daily": f"""
WITH j AS (SELECT l.l_linestatus, o.o_orderdate, l.l_shipdate FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
ev AS (SELECT l_linestatus, CAST(o_orderdate AS DATE) AS date, 'o' AS m FROM j WHERE o_orderdate IS NOT NULL
       UNION ALL SELECT l_linestatus, CAST(l_shipdate AS DATE), 's' FROM j WHERE l_shipdate IS NOT NULL)
SELECT l_linestatus, {sql_date('date')} AS date, COUNT(*) FILTER (WHERE m = 'o') AS lines_ordered,
       COUNT(*) FILTER (WHERE m = 's') AS lines_shipped FROM ev GROUP BY l_linestatus, date
""",
    "area_tree": _TREE + """
SELECT node_id, root_id, array_to_string(path, ' > ') AS path, depth, path[1] AS root_name, false AS in_loop
FROM deepest WHERE rn = 1
""",
    "region_revenue_month": _TREE + f"""
, tree AS (SELECT node_id, path[1] AS area FROM deepest WHERE rn = 1),
f AS (SELECT 'C' || CAST(o.o_custkey AS VARCHAR) AS node, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
             o.o_totalprice FROM orders o),
g AS (SELECT t.area, f.month, SUM(f.o_totalprice) AS v FROM f LEFT JOIN tree t ON t.node_id = f.node GROUP BY 1, 2),
p AS (SELECT g.*, pr.v AS pv, ROUND(g.v / NULLIF(SUM(g.v) OVER (PARTITION BY g.month), 0), 6) AS share_of_month
      FROM g LEFT JOIN g pr ON pr.area = g.area AND pr.month = g.month - INTERVAL 1 MONTH)
SELECT area, {sql_date('month')} AS month, ROUND(v, 2) AS o_totalprice, share_of_month, ROUND(pv, 2) AS prev_o_totalprice,
       ROUND(v - pv, 2) AS o_totalprice_change, ROUND((v - pv) / NULLIF(pv, 0), 6) AS o_totalprice_growth
FROM p
""",
}
