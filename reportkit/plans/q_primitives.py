"""Primitive operators exercised directly on the driver tables: successor chains
(R2), JSON and regex extraction (N2, N5, N6, N7), weighted averages, shares and
ranks (A12, W17, W3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.aggregates import weighted_avg
from ..functions.columns import extract_all, json_any, json_array_len, json_concat_text, rnd
from ..operators.arrays import explode_arrays
from ..operators.timegrid import follow_chain
from ..operators.windows import rank_within, seq_neighbors, share_of
from .common import load

LINK_PATTERN = 'href="([^"]+)"'


def event_chains(spark, d):
    e = load(spark, d, "events").select("user_id", "ts", "event_id")
    # successor = the user's next event; found per user x day, then across days
    links = seq_neighbors(e, "user_id", ["ts", "event_id"], ["event_id"], F.date_trunc("hour", "ts"), prev_prefix=None)
    links = links.select("event_id", "next_event_id")
    return follow_chain(links, "event_id", "next_event_id")


def event_props(spark, d):
    e = load(spark, d, "events")
    as_list = F.concat(F.lit("["), F.col("props"), F.lit("]"))  # the props object as a one-item list
    return e.select("event_id", json_any("props", ["$.k", "$.K", "$.key"]).try_cast("int").alias("k"),
                    json_concat_text(as_list, "$[*].k").alias("k_text"), json_array_len(as_list).alias("props_items"))


def page_links(spark, d):
    p = load(spark, d, "pages").select("page_id", extract_all("html", LINK_PATTERN).alias("links"))
    ex = explode_arrays(p, ["links"], out="link")
    return ex.groupBy("page_id").agg(F.count(F.lit(1)).alias("link_count"),
                                     F.count_distinct("link").alias("distinct_link_count"))


def supplier_scorecard(spark, d):
    li = load(spark, d, "lineitem")
    s = load(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    g = li.groupBy("l_suppkey").agg(rnd(F.sum("l_extendedprice"), 2).alias("revenue"),
                                    rnd(weighted_avg("l_discount", "l_quantity"), 6).alias("qty_weighted_discount"))
    g = g.join(s, "l_suppkey")
    g = share_of(g, "s_nationkey", "revenue", out="share_of_nation_revenue", digits=6)
    return rank_within(g, "s_nationkey", ["-revenue", "l_suppkey"], out="rank_in_nation")


SPINE_AS_OF = "2002-12-01"


def monthly_order_spine(spark, d):
    from ..operators.timegrid import spine
    o = load(spark, d, "orders")
    cal = spine(o, F.trunc(F.min(F.to_date("o_orderdate")), "month"), SPINE_AS_OF, "month", out="month")
    m = o.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(F.count(F.lit(1)).alias("orders"))
    out = cal.join(m, "month", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))
    return out.select(F.date_format("month", "yyyy-MM-dd").alias("month"), "orders")


QUERIES = {
    "monthly_order_spine": monthly_order_spine,
    "event_chains": event_chains,
    "event_props": event_props,
    "page_links": page_links,
    "supplier_scorecard": supplier_scorecard,
}

ORACLE = {
    "monthly_order_spine": f"""
WITH cal AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', MIN(o_orderdate)) AS DATE), DATE '{SPINE_AS_OF}',
                                                INTERVAL 1 MONTH)) AS DATE) AS month FROM orders),
m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS orders FROM orders GROUP BY 1)
SELECT strftime(cal.month, '%Y-%m-%d') AS month, COALESCE(m.orders, 0) AS orders FROM cal LEFT JOIN m USING (month)
""",
    # the chain along one user's events is linear, so the walk's end is a positional lookup
    "event_chains": """
WITH o AS (SELECT event_id, user_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
                  COUNT(*) OVER (PARTITION BY user_id) AS n FROM events),
t AS (SELECT o.event_id AS id, o.n - o.rn AS hops, o.user_id, o.rn FROM o)
SELECT t.id, o2.event_id AS final_id, t.hops, false AS in_loop FROM t JOIN o o2 ON o2.user_id IS NOT DISTINCT FROM t.user_id
  AND o2.rn = t.rn + t.hops
""",
    "event_props": """
SELECT event_id, TRY_CAST(COALESCE(json_extract_string(props, '$.k'), json_extract_string(props, '$.K'),
                                   json_extract_string(props, '$.key')) AS INTEGER) AS k,
       CASE WHEN json_valid('[' || props || ']') THEN COALESCE(json_extract_string(props, '$.k'), '') END AS k_text,
       CASE WHEN json_valid('[' || props || ']') THEN CAST(json_array_length('[' || props || ']') AS INTEGER) END AS props_items
FROM events
""",
    "page_links": """
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages)
SELECT page_id, COUNT(*) AS link_count, COUNT(DISTINCT link) AS distinct_link_count FROM l GROUP BY 1
""",
    "supplier_scorecard": """
WITH g AS (SELECT l_suppkey, ROUND(SUM(l_extendedprice), 2) AS revenue,
                  ROUND(SUM(l_discount * l_quantity) / NULLIF(SUM(l_quantity), 0), 6) AS qty_weighted_discount
           FROM lineitem GROUP BY 1),
j AS (SELECT g.*, s.s_nationkey FROM g JOIN supplier s ON s.s_suppkey = g.l_suppkey)
SELECT *, ROUND(revenue / NULLIF(SUM(revenue) OVER (PARTITION BY s_nationkey), 0), 6) AS share_of_nation_revenue,
       CAST(RANK() OVER (PARTITION BY s_nationkey ORDER BY revenue DESC, l_suppkey) AS INTEGER) AS rank_in_nation
FROM j
""",
}
