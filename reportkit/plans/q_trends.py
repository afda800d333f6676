"""Trend and inventory reports. Binding: pages list the people (e-mail addresses)
assigned to them; monthly order and line facts are growth series; events form an
app-store funnel (view -> click -> purchase); open orders are the entity inventory
per priority; orders are published by their priority and lines are edits on ship
day; events are sub-daily readings localised to a fixed zone; order totals are the
provider's reported daily figure and line sums the rebuilt one."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rnd
from ..operators import operations as op
from ..operators.marketing import EMAIL_PATTERN
from .common import finalize, load, sql_date, sx
from .q_primitives import LINK_PATTERN

NET = "ROUND(l_extendedprice * (1 - l_discount), 2)"
GROSS = f"{NET} + ROUND({NET} * l_tax, 2)"
INVENTORY_AS_OF = "2001-09-01"
LOCAL_ZONE = "America/New_York"


def page_assignments(spark, d):
    # a page's people and links as one JSON list of unlike entries; only the people are assigned
    entry = lambda kind: lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("value"))
    p = load(spark, d, "pages").select("page_id", F.to_json(F.concat(
        F.transform(F.regexp_extract_all("html", F.lit(LINK_PATTERN), 1), entry("link")),
        F.transform(F.regexp_extract_all("html", F.lit(EMAIL_PATTERN), 0), entry("person")))).alias("entries"))
    return op.assignments(p, "page_id", "entries", path="$", kind="$.kind", kinds=["person"], person="$.value")


def order_growth(spark, d):
    o = load(spark, d, "orders").groupBy(F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")).agg(
        rnd(F.avg("o_totalprice"), 2).alias("avg_order_value"))
    li = load(spark, d, "lineitem").groupBy(F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")).agg(
        rnd(F.avg("l_quantity"), 4).alias("avg_line_quantity"))
    g = op.growth_rates([o, li], [], "month", ["avg_order_value", "avg_line_quantity"])
    return finalize(g.withColumns({c: rnd(c, 4) for c in ["avg_order_value_change", "avg_line_quantity_change"]}))


def store_conversion(spark, d):
    e = load(spark, d, "events").withColumn("date", F.to_date("ts"))
    return finalize(op.store_conversion(e, ["date"], "event_type", ["view", "click", "purchase"]))


def open_order_inventory(spark, d):
    o = load(spark, d, "orders")
    inv = op.entity_inventory(o.select("o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus"), "o_orderkey",
                              "o_orderdate", F.col("o_orderstatus") == "O", INVENTORY_AS_OF)
    return op.entity_health(inv, ["o_orderpriority"])


def publishing_cadence(spark, d):
    o = load(spark, d, "orders").select("o_orderpriority", "o_orderdate")
    li = load(spark, d, "lineitem").select("l_orderkey", "l_shipdate").join(
        load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey")
    return finalize(op.publishing_cadence(o, li, "o_orderpriority", "o_orderdate", "l_shipdate"))


def local_day_readings(spark, d):
    e = load(spark, d, "events").withColumn("band", F.floor(F.col("value") / 10).cast("int"))
    return finalize(op.rollup_local_day(e, ["event_type"], "ts", "value", LOCAL_ZONE, "band"))


def reported_vs_rebuilt(spark, d):
    o = load(spark, d, "orders")
    rep = o.groupBy(F.to_date("o_orderdate").alias("date")).agg(rnd(F.sum("o_totalprice"), 2).alias("revenue"))
    li = load(spark, d, "lineitem").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    reb = li.groupBy(F.to_date("o_orderdate").alias("date")).agg(rnd(F.sum(sx(GROSS)), 2).alias("revenue"))
    return finalize(op.reported_vs_rebuilt(rep, reb, "date", "revenue"))


def profile_activity(spark, d):
    e = load(spark, d, "events").withColumn("date", F.to_date("ts"))
    # the view report and the engagement report come from one scan (conditional aggregates)
    is_view = F.col("event_type") == "view"
    both = e.groupBy("date", "event_type").agg(
        F.count_if(is_view).alias("views"), F.count_if(~is_view).alias("engagements"),
        rnd(F.coalesce(F.sum(F.when(~is_view, F.col("value"))), F.lit(0.0)), 2).alias("engagement_value"))
    return finalize(op.profile_activity([both], ["date", "event_type"], ["date"], "engagements"))


QUERIES = {
    "page_assignments": page_assignments,
    "order_growth": order_growth,
    "store_conversion": store_conversion,
    "open_order_inventory": open_order_inventory,
    "publishing_cadence": publishing_cadence,
    "local_day_readings": local_day_readings,
    "reported_vs_rebuilt": reported_vs_rebuilt,
    "profile_activity": profile_activity,
}

_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[a-z]{2,}"

ORACLE = {
    "page_assignments": f"""
SELECT DISTINCT page_id, unnest(list_distinct(regexp_extract_all(html, '{_EMAIL}', 0))) AS person FROM pages
""",
    "order_growth": f"""
WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, ROUND(AVG(o_totalprice), 2) AS avg_order_value
           FROM orders GROUP BY 1),
l AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, ROUND(AVG(l_quantity), 4) AS avg_line_quantity
      FROM lineitem GROUP BY 1),
m AS (SELECT * FROM o FULL JOIN l USING (month)),
w AS (SELECT *, LAG(avg_order_value) OVER (ORDER BY month) AS prev_avg_order_value,
             LAG(avg_line_quantity) OVER (ORDER BY month) AS prev_avg_line_quantity FROM m)
SELECT {sql_date('month')} AS month, avg_order_value, avg_line_quantity, prev_avg_order_value, prev_avg_line_quantity,
       ROUND(avg_order_value - prev_avg_order_value, 4) AS avg_order_value_change,
       ROUND((avg_order_value - prev_avg_order_value) / NULLIF(prev_avg_order_value, 0), 6) AS avg_order_value_growth,
       ROUND(avg_line_quantity - prev_avg_line_quantity, 4) AS avg_line_quantity_change,
       ROUND((avg_line_quantity - prev_avg_line_quantity) / NULLIF(prev_avg_line_quantity, 0), 6) AS avg_line_quantity_growth
FROM w
""",
    "store_conversion": f"""
WITH g AS (SELECT CAST(ts AS DATE) AS date, COUNT(*) FILTER (WHERE event_type = 'view') AS view,
                  COUNT(*) FILTER (WHERE event_type = 'click') AS click,
                  COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchase FROM events GROUP BY 1)
SELECT {sql_date('date')} AS date, view, click, purchase, ROUND(click::DOUBLE / NULLIF(view, 0), 6) AS click_rate,
       ROUND(click::DOUBLE / NULLIF(view, 0), 6) AS click_of_view,
       ROUND(purchase::DOUBLE / NULLIF(click, 0), 6) AS purchase_rate,
       ROUND(purchase::DOUBLE / NULLIF(view, 0), 6) AS purchase_of_view FROM g
""",
    "open_order_inventory": f"""
WITH i AS (SELECT o_orderpriority, o_orderstatus = 'O' AS is_open,
                  date_diff('day', CAST(o_orderdate AS DATE), DATE '{INVENTORY_AS_OF}') AS age_days FROM orders),
g AS (SELECT o_orderpriority, COUNT(*) AS entities, COUNT(*) FILTER (WHERE is_open) AS open_entities,
             COUNT(*) FILTER (WHERE is_open AND age_days > 365) AS stale_entities,
             ROUND(quantile_cont(age_days, 0.5), 2) AS median_age_days FROM i GROUP BY 1)
SELECT *, ROUND(stale_entities::DOUBLE / NULLIF(open_entities, 0), 6) AS stale_share FROM g
""",
    "publishing_cadence": f"""
WITH p AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS published
           FROM orders GROUP BY 1, 2),
r AS (SELECT o.o_orderpriority, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month, COUNT(*) AS edited
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2)
SELECT o_orderpriority, {sql_date('month')} AS month, COALESCE(published, 0) AS published, COALESCE(edited, 0) AS edited
FROM p FULL JOIN r USING (o_orderpriority, month)
""",
    "local_day_readings": f"""
WITH e AS (SELECT event_type, CAST(timezone('{LOCAL_ZONE}', CAST(ts AS TIMESTAMP) AT TIME ZONE 'UTC') AS DATE) AS local_date,
                  value, CAST(FLOOR(value / 10) AS INTEGER) AS band FROM events),
m AS (SELECT event_type, local_date, band, COUNT(*) AS c FROM e GROUP BY 1, 2, 3),
mo AS (SELECT event_type, local_date, band AS mode_category FROM
       (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type, local_date ORDER BY c DESC, band) AS rn FROM m) WHERE rn = 1),
g AS (SELECT event_type, local_date, MIN(value) AS min_value, MAX(value) AS max_value, SUM(value) AS s, COUNT(*) AS n
      FROM e GROUP BY 1, 2),
w AS (SELECT g.*, SUM(s) OVER x AS ps, SUM(n) OVER x AS pn FROM g
      WINDOW x AS (PARTITION BY event_type ORDER BY local_date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
SELECT w.event_type, {sql_date('w.local_date')} AS local_date, min_value, max_value, mo.mode_category,
       ROUND(s / n, 4) AS avg_value, ROUND(s / n - ps / NULLIF(pn, 0), 4) AS deviation_from_prior_7d
FROM w JOIN mo ON mo.event_type = w.event_type AND mo.local_date = w.local_date
""",
    "reported_vs_rebuilt": f"""
WITH r AS (SELECT CAST(o_orderdate AS DATE) AS date, ROUND(SUM(o_totalprice), 2) AS reported_revenue FROM orders GROUP BY 1),
b AS (SELECT CAST(o.o_orderdate AS DATE) AS date, ROUND(SUM({GROSS}), 2) AS rebuilt_revenue
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1)
SELECT {sql_date('date')} AS date, reported_revenue, rebuilt_revenue,
       ROUND(COALESCE(rebuilt_revenue, 0.0) - COALESCE(reported_revenue, 0.0), 2) AS revenue_difference
FROM r FULL JOIN b USING (date)
""",
    "profile_activity": f"""
WITH v AS (SELECT CAST(ts AS DATE) AS date, event_type, COUNT(*) AS views FROM events WHERE event_type = 'view' GROUP BY 1, 2),
g AS (SELECT CAST(ts AS DATE) AS date, event_type, COUNT(*) AS engagements, ROUND(SUM(value), 2) AS engagement_value
      FROM events WHERE event_type <> 'view' GROUP BY 1, 2),
m AS (SELECT date, event_type, COALESCE(views, 0) AS views, COALESCE(engagements, 0) AS engagements,
             COALESCE(engagement_value, 0) AS engagement_value FROM v FULL JOIN g USING (date, event_type))
SELECT {sql_date('date')} AS date, event_type, views, engagements, engagement_value,
       ROUND(engagements::DOUBLE / NULLIF(SUM(engagements) OVER (PARTITION BY date), 0), 6) AS share_of_engagements FROM m
""",
}
