"""The sales equation's shop rules (D11) on a change log.

Stand-ins: a line is an ORDER change (line 1 and 2) or an ORDER_EDIT, 45 seconds per line number after its order's date; a
line with return flag R is also refunded on its ship day (declined if its status is O and its number odd; three refunds per
order, by line number), one with flag A cancelled then, ten units more than ordered. Orders whose key ends
in 3, 4, 8 or 9 are child orders of the one before.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes as ch
from ..operators import commerce as cm
from .common import finalize, load, sql_date, sx
from .q_commerce import NET


def change_log(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_linestatus",
                                           F.col("l_quantity").cast("long").alias("qty"), F.round(sx(NET) * 100).cast("long").alias("cents"))
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("timestamp").alias("placed"))
    n = F.col("l_linenumber")
    at = F.col("placed") + F.make_dt_interval(secs=(n - 1) * 45)
    none = F.lit(None).cast("boolean")
    sale = F.struct(at.alias("happened_at"), F.when(n <= 2, "ORDER").otherwise("ORDER_EDIT").alias("kind"),
                    F.col("qty").alias("units"), F.col("cents").alias("amount"), none.alias("declined"))
    back = F.when(F.col("l_returnflag") == "R", F.struct(
        F.col("l_shipdate").cast("timestamp").alias("happened_at"), F.lit("RETURN").alias("kind"), (-F.col("qty")).alias("units"),
        (-F.col("cents")).alias("amount"), ((F.col("l_linestatus") == "O") & (n % 2 == 1)).alias("declined")))
    gone = F.when(F.col("l_returnflag") == "A", F.struct(
        F.col("l_shipdate").cast("timestamp").alias("happened_at"), F.lit("CANCELLATION").alias("kind"), (F.col("qty") + 10).alias("units"),
        F.lit(0).cast("long").alias("amount"), none.alias("declined")))
    j = li.join(o, "l_orderkey").select(F.col("l_orderkey").alias("order_id"), n.alias("line"), F.explode(F.array(sale, back, gone)).alias("c"))
    return j.where("c IS NOT NULL").select("order_id", "line", (F.col("order_id") * 10 + F.col("line") % 3).alias("refund_id"), "c.*")


def sales_with_edits(spark, d):
    c = ch.fold_edits(change_log(spark, d), "order_id", "happened_at", "kind").where(F.col("row_type") == "SALE")
    placed = F.col("kind") == "ORDER"
    return finalize(c.groupBy("report_date").agg(
        F.count_distinct(F.when(placed, F.col("order_id"))).alias("orders"),
        F.sum(F.when(placed, F.col("units")).otherwise(0)).alias("units_ordered"),
        F.sum(F.when(~F.col("is_later_edit"), F.col("units")).otherwise(0)).alias("units_with_checkout_edits"),
        F.sum("units").alias("units"), F.sum(F.when(~F.col("is_later_edit"), F.col("amount")).otherwise(0)).alias("net_cents_without_later_edits"),
        F.sum("amount").alias("net_cents")))


def refunds_by_parent_order(spark, d):
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"),
                                        F.when((F.col("o_orderkey") % 5) >= 3, F.col("o_orderkey") - 1).alias("parent_id"))
    r = change_log(spark, d).where(F.col("kind") == "RETURN").join(ch.report_orders(o, "order_id", "parent_id"), "order_id")
    r = cm.repoint_refunds(r, "order_id", "report_order_id", out="reported")
    return r.groupBy(F.col("reported").alias("report_order_id")).agg(
        F.count_distinct("order_id").alias("orders"), F.max("levels").alias("levels"), F.sum("units").alias("units"), F.sum("amount").alias("cents"))


def refunds_settled_by_day(spark, d):
    r = change_log(spark, d).where(F.col("kind") == "RETURN")
    r = cm.drop_declined_refunds(r, "refund_id", "declined")
    return finalize(r.groupBy(F.to_date("happened_at").alias("date")).agg(
        F.count_distinct("refund_id").alias("refunds"), F.count(F.lit(1)).alias("lines"), F.sum("amount").alias("cents")))


def cancellations_over_time(spark, d):
    """Units really cancelled per order and day; an order's lines of one moment count before its cancellations."""
    c = change_log(spark, d).where(F.col("kind") != "RETURN").withColumn("cancels", F.col("kind") == "CANCELLATION")
    c = ch.cap_over_time(c, ["order_id"], ["happened_at", "cancels", "line", "units"], F.when(~F.col("cancels"), F.col("units")),
                         F.when(F.col("cancels"), F.col("units")), F.to_date("happened_at"))
    return finalize(c.where("cancels").groupBy("order_id", F.to_date("happened_at").alias("date")).agg(
        F.sum("units").alias("units_asked"), F.sum("cancelled_capped").alias("units_cancelled")))


def credit_notes_by_month(spark, d):
    """Lines as invoices, refunds as credit notes stored with positive amounts; a line's cancelled units are capped."""
    c = change_log(spark, d).where(F.col("kind") != "CANCELLATION").withColumns({
        "amount": F.abs("amount"), "units": F.abs("units"), "cancelled": F.when(F.col("line") % 4 == 0, 30).otherwise(0)})
    c = cm.cap_cancelled(c, "cancelled", "units")
    c = cm.sign_credit_notes(c, ["amount", "units", "cancelled"], F.col("kind") == "RETURN")
    return finalize(c.groupBy(F.to_date(F.date_trunc("month", "happened_at")).alias("month")).agg(
        F.sum("amount").alias("cents"), F.sum("units").alias("units"), F.sum("cancelled").cast("long").alias("cancelled_units")))


QUERIES = {f.__name__: f for f in (sales_with_edits, refunds_by_parent_order, refunds_settled_by_day, cancellations_over_time, credit_notes_by_month)}

_LOG = f"""
WITH li AS (SELECT l.*, CAST(l_quantity AS BIGINT) AS qty, CAST(ROUND({NET} * 100, 0) AS BIGINT) AS cents, CAST(o_orderdate AS TIMESTAMP) AS placed
            FROM lineitem l JOIN orders ON o_orderkey = l_orderkey),
log AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, placed, placed + (l_linenumber - 1) * INTERVAL 45 SECOND AS happened_at,
         IF(l_linenumber <= 2, 'ORDER', 'ORDER_EDIT') AS kind, qty AS units, cents AS amount, NULL AS declined FROM li
  UNION ALL SELECT l_orderkey, l_linenumber, placed, l_shipdate, 'RETURN', -qty, -cents, l_linestatus = 'O' AND l_linenumber % 2 = 1 FROM li WHERE l_returnflag = 'R'
  UNION ALL SELECT l_orderkey, l_linenumber, placed, l_shipdate, 'CANCELLATION', qty + 10, 0, NULL FROM li WHERE l_returnflag = 'A')
"""

ORACLE = {
    "sales_with_edits": _LOG + f"""
, start AS (SELECT order_id, MIN(happened_at) AS created FROM log WHERE kind = 'ORDER' GROUP BY order_id),
s AS (SELECT log.*, kind = 'ORDER_EDIT' AND created IS NOT NULL AND epoch(happened_at) - epoch(created) BETWEEN 0 AND 90 AS checkout, created
      FROM log LEFT JOIN start USING (order_id) WHERE kind IN ('ORDER', 'ORDER_EDIT'))
SELECT {sql_date('IF(checkout, created, happened_at)')} AS report_date, COUNT(DISTINCT order_id) FILTER (kind = 'ORDER') AS orders,
       CAST(SUM(IF(kind = 'ORDER', units, 0)) AS BIGINT) AS units_ordered, CAST(SUM(IF(kind = 'ORDER' OR checkout, units, 0)) AS BIGINT) AS units_with_checkout_edits,
       CAST(SUM(units) AS BIGINT) AS units, CAST(SUM(IF(kind = 'ORDER' OR checkout, amount, 0)) AS BIGINT) AS net_cents_without_later_edits,
       CAST(SUM(amount) AS BIGINT) AS net_cents
FROM s GROUP BY {sql_date('IF(checkout, created, happened_at)')}
""",
    "refunds_by_parent_order": _LOG + """
SELECT order_id - greatest(order_id % 5 - 2, 0) AS report_order_id, COUNT(DISTINCT order_id) AS orders, MAX(greatest(order_id % 5 - 2, 0)) AS levels,
       CAST(SUM(units) AS BIGINT) AS units, CAST(SUM(amount) AS BIGINT) AS cents
FROM log WHERE kind = 'RETURN' GROUP BY order_id - greatest(order_id % 5 - 2, 0)
""",
    "refunds_settled_by_day": _LOG + f"""
, r AS (SELECT *, bool_and(declined) OVER (PARTITION BY order_id, line % 3) AS lost FROM log WHERE kind = 'RETURN')
SELECT {sql_date('happened_at')} AS date, COUNT(DISTINCT order_id * 10 + line % 3) AS refunds, COUNT(*) AS lines, CAST(SUM(amount) AS BIGINT) AS cents
FROM r WHERE NOT lost GROUP BY {sql_date('happened_at')}
""",
    # the fold itself, change by change
    "cancellations_over_time": _LOG + f"""
, c AS (SELECT order_id, happened_at, kind = 'CANCELLATION' AS cancels, line, units,
               ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY happened_at, kind = 'CANCELLATION', line, units) AS i FROM log WHERE kind <> 'RETURN'),
steps AS (SELECT order_id, list({{'o': IF(cancels, 0, units), 'c': IF(cancels, units, 0), 'state': CAST(0 AS BIGINT)}} ORDER BY i) AS steps FROM c GROUP BY order_id),
state AS (
  SELECT c.*, list_reduce(list_prepend({{'o': CAST(0 AS BIGINT), 'c': CAST(0 AS BIGINT), 'state': CAST(0 AS BIGINT)}}, steps[1:i]),
      lambda s, x: {{'o': s.o + x.o, 'c': CAST(0 AS BIGINT), 'state': least(s.state + x.c, s.o + x.o)}}).state AS upto,
      list_reduce(list_prepend({{'o': CAST(0 AS BIGINT), 'c': CAST(0 AS BIGINT), 'state': CAST(0 AS BIGINT)}}, steps[1:i - 1]),
      lambda s, x: {{'o': s.o + x.o, 'c': CAST(0 AS BIGINT), 'state': least(s.state + x.c, s.o + x.o)}}).state AS before
  FROM c JOIN steps USING (order_id) WHERE cancels)
SELECT order_id, {sql_date('happened_at')} AS date, CAST(SUM(units) AS BIGINT) AS units_asked, CAST(SUM(upto - before) AS BIGINT) AS units_cancelled
FROM state GROUP BY order_id, {sql_date('happened_at')}
""",
    "credit_notes_by_month": _LOG + f"""
, c AS (SELECT happened_at, IF(kind = 'RETURN', -1, 1) AS sign, abs(amount) AS amount, abs(units) AS units, IF(line % 4 = 0, least(30, abs(units)), 0) AS cancelled
        FROM log WHERE kind <> 'CANCELLATION')
SELECT {sql_date("date_trunc('month', happened_at)")} AS month, CAST(SUM(sign * amount) AS BIGINT) AS cents, CAST(SUM(sign * units) AS BIGINT) AS units,
       CAST(SUM(sign * cancelled) AS BIGINT) AS cancelled_units
FROM c GROUP BY {sql_date("date_trunc('month', happened_at)")}
""",
}
