"""Logistics and workforce reports. Binding: a lineitem is a shipment from its
supplier's nation to its customer's nation (weight = quantity, freight cost = tax
on the net value, estimate = 30 days); returned lines are claims; lines of an order
are its dependencies / checklist; a supplier's shipped quantity is its hours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import commerce as cm
from ..operators import operations as op
from .common import finalize, load, sql_date, sx

NET = "ROUND(l_extendedprice * (1 - l_discount), 2)"
# Weekly capacity hours per supplier and the shift states of the roster binding.
WEEKLY_CAPACITY = 400.0
SHIFT_STATES = {"filled": ["F"], "open": ["O"]}


def _shipments(spark, d):
    li = load(spark, d, "lineitem")
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_custkey")
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("dest_nation"))
    s = load(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("origin_nation"))
    return (li.join(o, "l_orderkey").join(c, "o_custkey").join(s, "l_suppkey")
            .withColumns({"freight_cost": sx(f"ROUND({NET} * l_tax, 2)"), "estimated_days": F.lit(30)}))


def shipment_lanes(spark, d):
    return finalize(cm.shipment_lanes(_shipments(spark, d), ["origin_nation", "dest_nation"], "o_orderdate",
                                      "l_quantity", "freight_cost", "l_shipdate", "estimated_days"))


def claims_by_month(spark, d):
    li = load(spark, d, "lineitem")
    p = load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lp = li.join(p, "l_partkey")
    return finalize(cm.claims_by_month(lp.where(F.col("l_returnflag") == "R"), lp, ["p_type"], "l_shipdate",
                                       "l_linestatus", "l_shipdate"))


def order_dependencies(spark, d):
    o = load(spark, d, "orders").select("o_orderkey")
    li = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus")
    return op.dependency_counts(o, li, "o_orderkey", "l_linestatus", ["O"])


def order_checklists(spark, d):
    li = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus")
    return op.checklist_progress(li, "o_orderkey", F.col("l_linestatus") == "F")


def supplier_utilization(spark, d):
    li = load(spark, d, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    return finalize(op.utilization(li, "l_suppkey", "l_shipdate", "l_quantity", WEEKLY_CAPACITY, week_start_dow=2))


def roster_coverage(spark, d):
    li = load(spark, d, "lineitem").select("l_shipdate", "l_linestatus", "l_returnflag")
    return finalize(op.coverage(li, ["l_returnflag"], "l_shipdate", "l_linestatus", SHIFT_STATES))


def booking_lead_time(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity")
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return op.booking_lead_time(li.join(o, "l_orderkey"), "o_orderdate", "l_shipdate", "l_quantity")


QUERIES = {
    "shipment_lanes": shipment_lanes,
    "claims_by_month": claims_by_month,
    "order_dependencies": order_dependencies,
    "order_checklists": order_checklists,
    "supplier_utilization": supplier_utilization,
    "roster_coverage": roster_coverage,
    "booking_lead_time": booking_lead_time,
}

ORACLE = {
    "shipment_lanes": f"""
WITH j AS (SELECT s.s_nationkey AS origin_nation, c.c_nationkey AS dest_nation,
                  CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month, l.l_quantity,
                  ROUND({NET} * l.l_tax, 2) AS cost,
                  CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS transit
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
           JOIN supplier s ON s.s_suppkey = l.l_suppkey),
g AS (SELECT origin_nation, dest_nation, month, COUNT(*) AS shipments, ROUND(SUM(l_quantity), 2) AS total_weight,
             ROUND(SUM(cost), 2) AS total_cost, ROUND(AVG(transit), 4) AS avg_transit_days,
             COUNT(*) FILTER (WHERE transit <= 30) AS on_time_shipments FROM j GROUP BY 1, 2, 3)
SELECT origin_nation, dest_nation, {sql_date('month')} AS month, shipments, total_weight, total_cost, avg_transit_days,
       on_time_shipments, ROUND(total_cost / NULLIF(total_weight, 0), 4) AS cost_per_kg,
       ROUND(on_time_shipments::DOUBLE / NULLIF(shipments, 0), 6) AS on_time_rate FROM g
""",
    "claims_by_month": f"""
WITH lp AS (SELECT l.*, p.p_type, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month
            FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
c AS (SELECT p_type, month, COUNT(*) AS claims, COUNT(*) FILTER (WHERE l_linestatus IN ('F')) AS resolved_claims,
             COUNT(*) FILTER (WHERE l_linestatus NOT IN ('F') AND l_linestatus IN ('O')) AS open_claims
      FROM lp WHERE l_returnflag = 'R' GROUP BY 1, 2),
b AS (SELECT p_type, month, COUNT(*) AS base_volume FROM lp GROUP BY 1, 2),
f AS (SELECT COALESCE(c.p_type, b.p_type) AS p_type, COALESCE(c.month, b.month) AS month, claims, resolved_claims,
             open_claims, base_volume FROM c FULL JOIN b ON b.p_type = c.p_type AND b.month = c.month),
s AS (SELECT p_type, MIN(month) AS s FROM f GROUP BY 1), e AS (SELECT MAX(month) AS e FROM f),
grid AS (SELECT s.p_type, CAST(unnest(generate_series(s.s, GREATEST(e.e, s.s), INTERVAL 1 MONTH)) AS DATE) AS month
         FROM s CROSS JOIN e),
j AS (SELECT grid.p_type, grid.month, COALESCE(claims, 0) AS claims, COALESCE(resolved_claims, 0) AS resolved_claims,
             COALESCE(open_claims, 0) AS open_claims, COALESCE(base_volume, 0) AS base_volume
      FROM grid LEFT JOIN f ON f.p_type = grid.p_type AND f.month = grid.month)
SELECT p_type, {sql_date('month')} AS month, claims, resolved_claims, open_claims, base_volume,
       ROUND(claims::DOUBLE / NULLIF(base_volume, 0), 6) AS claim_rate FROM j
""",
    "order_dependencies": """
WITH d AS (SELECT l_orderkey, COUNT(*) AS dependencies, COUNT(*) FILTER (WHERE l_linestatus IN ('O')) AS open_dependencies,
                  COUNT(*) FILTER (WHERE l_linestatus IS NULL) AS unknown FROM lineitem GROUP BY 1),
j AS (SELECT o.o_orderkey, COALESCE(d.dependencies, 0) AS dependencies, COALESCE(d.open_dependencies, 0) AS open_dependencies,
             COALESCE(d.unknown, 0) AS unknown FROM orders o LEFT JOIN d ON d.l_orderkey = o.o_orderkey)
SELECT o_orderkey, dependencies, open_dependencies,
       CASE WHEN dependencies = 0 THEN 'none' WHEN unknown > 0 THEN 'unknown' WHEN open_dependencies > 0 THEN 'blocked'
            ELSE 'clear' END AS blocker_state FROM j
""",
    "order_checklists": """
SELECT l_orderkey AS o_orderkey, COUNT(*) AS checklist_items, COUNT(*) FILTER (WHERE l_linestatus = 'F') AS resolved_items,
       ROUND(COUNT(*) FILTER (WHERE l_linestatus = 'F')::DOUBLE / NULLIF(COUNT(*), 0), 6) AS resolved_share
FROM lineitem GROUP BY 1
""",
    "supplier_utilization": f"""
WITH w AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) - CAST(((dayofweek(CAST(l_shipdate AS DATE)) + 1 - 2 + 7) % 7) AS INTEGER)
                  AS week_start, l_quantity FROM lineitem)
SELECT l_suppkey, {sql_date('week_start')} AS week_start, SUM(l_quantity) AS hours, CAST(400.0 AS DOUBLE) AS capacity_hours,
       ROUND(SUM(l_quantity) / 400.0, 6) AS utilization FROM w GROUP BY 1, 2
""",
    "roster_coverage": f"""
WITH g AS (SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag, COUNT(*) AS shifts,
                  COUNT(*) FILTER (WHERE l_linestatus IN ('F')) AS filled, COUNT(*) FILTER (WHERE l_linestatus IN ('O')) AS open
           FROM lineitem GROUP BY 1, 2)
SELECT {sql_date('date')} AS date, l_returnflag, shifts, filled, open,
       ROUND(filled::DOUBLE / NULLIF(shifts, 0), 6) AS filled_rate FROM g
""",
    "booking_lead_time": """
WITH j AS (SELECT CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS lead,
                  l.l_quantity FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT CASE WHEN lead IS NULL THEN 'unknown' WHEN lead <= 7 THEN '0-7 days' WHEN lead <= 30 THEN '8-30 days'
            WHEN lead <= 90 THEN '31-90 days' ELSE '91+ days' END AS lead_time_band,
       CASE WHEN lead IS NULL THEN 5 WHEN lead <= 7 THEN 1 WHEN lead <= 30 THEN 2 WHEN lead <= 90 THEN 3 ELSE 4 END AS band_order,
       COUNT(*) AS bookings, SUM(l_quantity) AS covers, CAST(SUM(lead) AS BIGINT) AS lead_days_sum
FROM j GROUP BY 1, 2
""",
}
