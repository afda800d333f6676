"""Bindings of stored summaries and of operators on a global order: quantile sketches (A6), bitmaps of users (A3, D03),
most frequent values (A7), ranges without keys (J5), trailing frames (W12) and ranks (W3) of hot keys.

Stand-ins: a line's price in cents is the measured value and its ship date its day; an error event opens a window of ten
minutes; a supplier's number sets a price band (every tenth has no upper end, every seventh no lower one).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sketches as sk
from ..operators.joins import join_ns
from ..operators.sorting import distinct_after, range_totals, rank_over_ranges
from ..operators.windows import trailing_over_days, trailing_window
from ..session import cut_lineage
from .common import finalize, load, sql_date

QUANTILES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


def price_quantiles_by_period(spark, d):
    """Daily sketches are stored, then merged per month and over all days; every answer's exact rank is checked."""
    li = load(spark, d, "lineitem").select("l_returnflag", "l_shipdate", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    daily = cut_lineage(sk.daily_quantile_sketches(li, ["l_returnflag"], "l_shipdate", "cents"))
    out = None
    for grain, period in (("month", F.trunc("day", "month")), ("all", None)):
        answers = sk.sketch_quantiles(sk.merge_quantile_sketches(daily, ["l_returnflag"], period, "bigint", "period"), QUANTILES, "bigint")
        facts = li.withColumn("period", F.trunc(F.to_date("l_shipdate"), "month") if period is not None else F.lit(None).cast("date"))
        checked = sk.rank_bounds(facts, answers, ["l_returnflag", "period"], "cents", QUANTILES, sk.rank_error()).select(
            F.lit(grain).alias("grain"), "l_returnflag", "period", "n", *[f"{q}_in_bound" for q in QUANTILES])
        out = checked if out is None else out.unionByName(checked)
    return finalize(out)


def distinct_users_by_period(spark, d):
    e = load(spark, d, "events").select("event_type", "ts", "user_id")
    daily = cut_lineage(sk.daily_bitmaps(e, ["event_type"], "ts", "user_id"))
    return finalize(sk.distinct_over_periods(daily, ["event_type"], {
        "day": F.col("day"), "week": F.trunc("day", "week"), "month": F.trunc("day", "month"), "quarter": F.trunc("day", "quarter")}))


def usual_quantity_by_supplier(spark, d):
    li = load(spark, d, "lineitem").select("l_suppkey", F.when(F.col("l_discount") > 0, F.col("l_quantity")).alias("l_quantity"))
    return sk.most_frequent(li, ["l_suppkey"], "l_quantity", out="usual_quantity", count_out="lines")


def frequent_quantities_by_month(spark, d):
    li = load(spark, d, "lineitem").select("l_shipdate", F.col("l_quantity").cast("long").alias("quantity"))
    out = sk.frequent_items(li, [], "l_shipdate", "quantity", F.trunc("_day", "month"), share=0.021)
    return finalize(out.select(F.col("period").alias("month"), "quantity", F.col("n").alias("lines")))


def events_after_errors(spark, d):
    """Events of the ten minutes after each error: ranges of timestamps without an equality key, summed without the pairs."""
    length = F.expr("INTERVAL 10 MINUTES")
    e = load(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    errors = e.where(F.col("event_type") == "error").groupBy(
        F.col("event_id").alias("error_id"), F.col("ts").alias("opened"), (F.col("ts") + length).alias("closed")).agg(F.count(F.lit(1)).alias("times"))
    sums = {"events": F.lit(1), "purchases": (F.col("event_type") == "purchase").cast("long")}
    totals = range_totals(e, errors, "ts", "opened", "closed", sums)
    totals = totals.groupBy("error_id").agg(*[F.sum(F.col("times") * F.col(c)).alias(c) for c in sums])
    users = distinct_after(e, errors, "user_id", "ts", "error_id", "opened", "closed", length, "users")
    return join_ns(totals, users, "error_id").select("error_id", "events", "users", "purchases")


def orders_in_price_bands(spark, d):
    """Orders per price band, bands open on either side included; orders in no band are counted under NULL."""
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    s = F.col("s_suppkey")
    bands = load(spark, d, "supplier").select(
        s.alias("band"), F.when(s % 7 != 0, (s * 4000).cast("double")).alias("low"), F.when(s % 10 != 0, (s * 4000 + 9000).cast("double")).alias("high"))
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    t = range_totals(o, bands, "o_totalprice", "low", "high", {"orders": F.lit(1), "cents": cents, "priced": cents.isNotNull().cast("long")}, "[]", unmatched=True)
    # the sum of no price is NULL
    return t.groupBy("band").agg(F.sum("orders").alias("orders"), F.when(F.sum("priced") > 0, F.sum("cents")).alias("cents"))


def event_trailing_values(spark, d):
    """Per event: cents of its user over the last six hours, and the largest value of its type over the last three days."""
    e = load(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value", F.round(F.col("value") * 100).cast("long").alias("cents"))
    e = trailing_window(e, "user_id", "ts", "cents", 6 * 3600, "sum", out="cents_6h")
    e = trailing_over_days(e, "event_type", "ts", "value", 3, "max", out="max_value_3d")
    e = trailing_over_days(e, "event_type", "ts", "value", 3, "count", include_current=False, out="events_before_3d")
    return e.select("event_id", "cents_6h", "max_value_3d", "events_before_3d")


def order_price_ranks(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,0)").cast("long").alias("price"))
    out = rank_over_ranges(o, ["o_orderstatus"], ["-price"], "rank", "dense_rank")
    return out.select("o_orderkey", "o_orderstatus", "price", F.col("rank").cast("long").alias("rank"), F.col("dense_rank").cast("long").alias("dense_rank"))


QUERIES = {f.__name__: f for f in (price_quantiles_by_period, distinct_users_by_period, usual_quantity_by_supplier, frequent_quantities_by_month,
                                   events_after_errors, orders_in_price_bands, event_trailing_values, order_price_ranks)}

ORACLE = {
    # the sketch may answer any value whose exact rank lies in the bound: the check itself is the expected value
    "price_quantiles_by_period": f"""
WITH li AS (SELECT l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE) AS month FROM lineitem
            WHERE l_extendedprice IS NOT NULL)
SELECT 'month' AS grain, l_returnflag, {sql_date('month')} AS period, COUNT(*) AS n, true AS p50_in_bound, true AS p90_in_bound, true AS p99_in_bound
FROM li GROUP BY l_returnflag, month
UNION ALL SELECT 'all', l_returnflag, NULL, COUNT(*), true, true, true FROM li GROUP BY l_returnflag
""",
    "distinct_users_by_period": f"""
WITH g AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day, unnest(['day', 'week', 'month', 'quarter']) AS grain FROM events WHERE user_id IS NOT NULL)
SELECT event_type, grain, {sql_date("date_trunc(grain, day)")} AS period_start, COUNT(DISTINCT user_id) AS users
FROM g GROUP BY event_type, grain, {sql_date("date_trunc(grain, day)")}
""",
    "usual_quantity_by_supplier": """
WITH c AS (SELECT l_suppkey, l_quantity, COUNT(*) AS n FROM lineitem WHERE l_discount > 0 GROUP BY ALL),
b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_quantity) AS rn FROM c)
SELECT s.l_suppkey, b.l_quantity AS usual_quantity, IFNULL(b.n, 0) AS lines
FROM (SELECT DISTINCT l_suppkey FROM lineitem) s LEFT JOIN b ON b.l_suppkey = s.l_suppkey AND b.rn = 1
""",
    "frequent_quantities_by_month": f"""
WITH c AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(l_quantity AS BIGINT) AS quantity, COUNT(*) AS lines FROM lineitem GROUP BY ALL),
t AS (SELECT *, SUM(lines) OVER (PARTITION BY month) AS total FROM c)
SELECT {sql_date('month')} AS month, quantity, lines FROM t WHERE lines >= CAST(0.021 AS DOUBLE) * total
""",
    "events_after_errors": """
SELECT x.event_id AS error_id, COUNT(*) AS events, COUNT(DISTINCT e.user_id) AS users, COUNT(*) FILTER (e.event_type = 'purchase') AS purchases
FROM events x JOIN events e ON e.ts >= x.ts AND e.ts < x.ts + INTERVAL 10 MINUTES WHERE x.event_type = 'error' GROUP BY x.event_id
""",
    "orders_in_price_bands": """
WITH b AS (SELECT s_suppkey AS band, IF(s_suppkey % 7 <> 0, s_suppkey * 4000.0, NULL)::DOUBLE AS low, IF(s_suppkey % 10 <> 0, s_suppkey * 4000.0 + 9000, NULL)::DOUBLE AS high FROM supplier)
SELECT b.band, COUNT(*) AS orders, CAST(SUM(CAST(ROUND(o_totalprice * 100, 0) AS BIGINT)) AS BIGINT) AS cents
FROM orders o LEFT JOIN b ON o_totalprice >= IFNULL(low, '-infinity'::DOUBLE) AND o_totalprice <= IFNULL(high, 'infinity'::DOUBLE) GROUP BY b.band
""",
    "event_trailing_values": """
WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, MAX(value) AS top, COUNT(value) AS n FROM events GROUP BY ALL)
SELECT event_id,
       CAST(SUM(CAST(ROUND(value * 100, 0) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS BIGINT) AS cents_6h,
       (SELECT MAX(top) FROM daily d WHERE d.event_type = e.event_type AND d.day BETWEEN CAST(e.ts AS DATE) - 2 AND CAST(e.ts AS DATE)) AS max_value_3d,
       (SELECT CAST(IFNULL(SUM(n), 0) AS BIGINT) FROM daily d WHERE d.event_type = e.event_type AND d.day BETWEEN CAST(e.ts AS DATE) - 3 AND CAST(e.ts AS DATE) - 1) AS events_before_3d
FROM events e
""",
    "order_price_ranks": """
WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12,0)) AS BIGINT) AS price FROM orders)
SELECT *, RANK() OVER (PARTITION BY o_orderstatus ORDER BY price DESC) AS rank, DENSE_RANK() OVER (PARTITION BY o_orderstatus ORDER BY price DESC) AS dense_rank FROM o
""",
}
