"""Customer profiles built from the generic primitives (joins J1/J2/J8/J9/J12,
aggregate builders A1-A5/A9/A13/A14, windows W5/W9/W10/W14/W15, column builders
P6/P7/P11/P12/P13/T3/T6/F3/F6, settings S5). Binding: orders and their lines
per customer; a customer's primary supplier is the one with the most line value."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import aggregates as A
from ..functions import columns as C
from ..operators import aggs, joins, windows
from ..sources import with_settings
from .common import finalize, load, sql_date

AS_OF = "2001-12-31"
# The urgent priorities and the big-order threshold of the profile.
URGENT = ["1-URGENT", "2-HIGH"]
BIG_ORDER = 300000.0


def customer_order_profile(spark, d):
    o = load(spark, d, "orders")
    li = load(spark, d, "lineitem")
    with_lines = joins.semi_join(o.withColumnRenamed("o_orderkey", "l_orderkey"),
                                 aggs.distinct_keys(li, ["l_orderkey"]), "l_orderkey")
    status = F.col("o_orderstatus")
    prof = aggs.group_agg(with_lines, "o_custkey", {
        "orders": F.count(F.lit(1)),
        "fulfilled_orders": A.count_when(C.eq_ns(status, F.lit("F"))),
        "open_value": A.sum_when("o_totalprice", status == "O"),
        "first_fulfilled": A.min_when(F.to_date("o_orderdate"), status == "F"),
        "last_open": A.max_when(F.to_date("o_orderdate"), status == "O"),
        "priorities_not_partial": A.count_distinct_when("o_orderpriority", status != "P"),
        "any_status": A.any_value_det("o_orderstatus"),
        "has_big_order": A.any_true(F.col("o_totalprice") > BIG_ORDER),
        "all_fulfilled": A.all_true(status == "F"),
        "urgent_orders": A.count_when(C.in_array(F.col("o_orderpriority"), F.array(*[F.lit(u) for u in URGENT]))),
        "priority_list": A.string_list("o_orderpriority", ",", distinct=True),
        "single_status": A.unique_or_null("o_orderstatus"),
        "total_value": F.sum("o_totalprice")})
    prof = C.fill(prof, {"open_value": 0.0})
    prof = prof.withColumns({"open_value": C.rnd("open_value", 2),
                             "total_value_k": C.rnd(C.scale_unit("total_value", 1000), 3),
                             "fulfilled_share": C.ratio("fulfilled_orders", "orders", digits=6)}).drop("total_value")
    lines = joins.inner_join(li.select("l_orderkey", "l_suppkey", "l_extendedprice"),
                             o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    assoc = aggs.group_agg(lines, ["o_custkey", "l_suppkey"], {"line_value": F.sum("l_extendedprice")})
    prof = joins.primary_association(prof, assoc, "o_custkey", "l_suppkey", [F.col("line_value"), F.col("l_suppkey")])
    cust = load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return finalize(joins.enrich(prof, cust, "o_custkey").withColumnRenamed("l_suppkey", "primary_supplier"))


def customers_without_orders(spark, d):
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return joins.anti_join(c, load(spark, d, "orders"), "o_custkey")


def customer_monthly_balance(spark, d):
    o = load(spark, d, "orders")
    m = aggs.group_agg(o, ["o_custkey", C.period(F.col("o_orderdate"), "month").alias("month")], {
        "orders": F.count(F.lit(1)),
        "net_value": F.sum(C.signed(F.col("o_totalprice"), F.col("o_orderstatus") == "P"))})
    m = windows.running_total(m, "o_custkey", "month", "net_value", out="closing_value")
    m = windows.opening_balance(m, "o_custkey", "month", "net_value", out="opening_value")
    m = windows.first_in(m, "o_custkey", "month", "net_value", out="first_month_value")
    m = windows.max_before(m, "o_custkey", "month", "net_value", out="max_prior_value")
    m = windows.prev(m, "o_custkey", "month", "month", out="prev_month")
    m = windows.next_(m, "o_custkey", "month", "month", out="next_month")
    m = m.withColumns({"months_since_prev": C.duration(F.col("prev_month").cast("timestamp"),
                                                       F.col("month").cast("timestamp"), "MONTH"),
                       "snapshot_date": C.snapshot_date(F.col("month"), AS_OF)})
    m = with_settings(m, report_currency="USD")
    money = ["net_value", "closing_value", "opening_value", "first_month_value", "max_prior_value"]
    return finalize(m.withColumns({c: C.rnd(c, 2) for c in money}))


def priority_month_grid(spark, d):
    from ..operators.timegrid import spine
    o = load(spark, d, "orders")
    months = spine(o, F.trunc(F.min(F.to_date("o_orderdate")), "month"), F.trunc(F.max(F.to_date("o_orderdate")), "month"),
                   "month", out="month")
    # Dims x calendar; the calendar side is bounded by its span, so it is the broadcast one
    grid = joins.cross_join(aggs.distinct_keys(o, ["o_orderpriority"]), months, small=True)
    counts = aggs.group_agg(o, ["o_orderpriority", F.trunc(F.to_date("o_orderdate"), "month").alias("month")],
                            {"orders": F.count(F.lit(1))})
    out = grid.join(counts, ["o_orderpriority", "month"], "left")
    return finalize(C.fill(out, {"orders": 0}))


QUERIES = {
    "priority_month_grid": priority_month_grid,
    "customer_order_profile": customer_order_profile,
    "customers_without_orders": customers_without_orders,
    "customer_monthly_balance": customer_monthly_balance,
}

ORACLE = {
    "priority_month_grid": f"""
WITH b AS (SELECT CAST(date_trunc('month', MIN(o_orderdate)) AS DATE) AS s, CAST(date_trunc('month', MAX(o_orderdate)) AS DATE) AS e
           FROM orders),
m AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
p AS (SELECT DISTINCT o_orderpriority FROM orders),
c AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS orders FROM orders GROUP BY 1, 2)
SELECT p.o_orderpriority, {sql_date('m.month')} AS month, COALESCE(c.orders, 0) AS orders
FROM p CROSS JOIN m LEFT JOIN c ON c.o_orderpriority IS NOT DISTINCT FROM p.o_orderpriority AND c.month = m.month
""",
    "customer_order_profile": f"""
WITH o AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem)),
p AS (SELECT o_custkey, COUNT(*) AS orders,
             COUNT(*) FILTER (WHERE o_orderstatus IS NOT DISTINCT FROM 'F') AS fulfilled_orders,
             ROUND(COALESCE(SUM(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 0.0), 2) AS open_value,
             MIN(CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END) AS first_fulfilled,
             MAX(CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) END) AS last_open,
             COUNT(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END) AS priorities_not_partial,
             MIN(o_orderstatus) AS any_status, BOOL_OR(o_totalprice > {BIG_ORDER}) AS has_big_order,
             BOOL_AND(o_orderstatus = 'F') AS all_fulfilled,
             COUNT(*) FILTER (WHERE COALESCE(o_orderpriority IN ({", ".join(f"'{u}'" for u in URGENT)}), FALSE)) AS urgent_orders,
             array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') AS priority_list,
             CASE WHEN COUNT(DISTINCT o_orderstatus) = 1 THEN MIN(o_orderstatus) END AS single_status,
             ROUND(SUM(o_totalprice) / 1000.0, 3) AS total_value_k,
             ROUND(COUNT(*) FILTER (WHERE o_orderstatus IS NOT DISTINCT FROM 'F')::DOUBLE / NULLIF(COUNT(*), 0), 6)
               AS fulfilled_share
      FROM o GROUP BY 1),
a AS (SELECT o.o_custkey, l.l_suppkey, SUM(l.l_extendedprice) AS v FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
      GROUP BY 1, 2),
b AS (SELECT o_custkey, arg_max(l_suppkey, (v, l_suppkey)) AS primary_supplier FROM a GROUP BY 1),
c AS (SELECT c_custkey, MAX(c_mktsegment) AS c_mktsegment FROM customer GROUP BY 1)
SELECT p.o_custkey, orders, fulfilled_orders, open_value, {sql_date('first_fulfilled')} AS first_fulfilled,
       {sql_date('last_open')} AS last_open, priorities_not_partial, any_status, has_big_order, all_fulfilled, urgent_orders,
       priority_list, single_status, total_value_k, fulfilled_share, b.primary_supplier, c.c_mktsegment
FROM p LEFT JOIN b ON b.o_custkey = p.o_custkey LEFT JOIN c ON c.c_custkey = p.o_custkey
""",
    "customers_without_orders": """
SELECT c_custkey AS o_custkey, c_name, c_mktsegment FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
""",
    "customer_monthly_balance": f"""
WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS orders,
                  SUM(CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END) AS net_value
           FROM orders GROUP BY 1, 2),
w AS (SELECT *, SUM(net_value) OVER (PARTITION BY o_custkey ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                  AS closing_value,
             COALESCE(SUM(net_value) OVER (PARTITION BY o_custkey ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS opening_value,
             FIRST_VALUE(net_value IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY month
                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_month_value,
             MAX(net_value) OVER (PARTITION BY o_custkey ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                  AS max_prior_value,
             LAG(month) OVER (PARTITION BY o_custkey ORDER BY month) AS prev_month,
             LEAD(month) OVER (PARTITION BY o_custkey ORDER BY month) AS next_month FROM m)
SELECT o_custkey, {sql_date('month')} AS month, orders, ROUND(net_value, 2) AS net_value, ROUND(closing_value, 2) AS closing_value,
       ROUND(opening_value, 2) AS opening_value, ROUND(first_month_value, 2) AS first_month_value,
       ROUND(max_prior_value, 2) AS max_prior_value, {sql_date('prev_month')} AS prev_month, {sql_date('next_month')} AS next_month,
       date_diff('month', prev_month, month) AS months_since_prev,
       {sql_date(f"LEAST(last_day(month), DATE '{AS_OF}')")} AS snapshot_date, 'USD' AS report_currency
FROM w
""",
}
