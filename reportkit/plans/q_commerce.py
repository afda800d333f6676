"""Commerce reports bound to orders / lineitem / part / customer.

Binding: every line is a SALE on its order's day; a line with
``l_returnflag = 'R'`` is also a RETURN on its ship day (negative money).
Net line value = ``l_extendedprice * (1 - l_discount)``; tax on top of it.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import rnd

from ..operators import commerce as cm
from ..operators.joins import enrich
from ..session import tasks_for
from .common import finalize, load, sql_date, sql_ts, sx

# line money is posted in cents before it is summed (engine-independent totals)
NET = "ROUND(l_extendedprice * (1 - l_discount), 2)"
DISC = "ROUND(l_extendedprice * l_discount, 2)"
TAX = f"ROUND({NET} * l_tax, 2)"


def order_lines(spark, d):
    """Typed line events (one lineitem scan, SALE + optional RETURN row via explode)."""
    li = load(spark, d, "lineitem")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    j = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "o_orderstatus", "o_orderdate", "l_shipdate", "l_returnflag", "l_quantity",
        sx(NET).alias("net"), sx(DISC).alias("disc"), sx(TAX).alias("tax"))
    net, disc, tax = F.col("net"), F.col("disc"), F.col("tax")
    sale = F.struct(F.to_date("o_orderdate").alias("report_date"), F.lit("SALE").alias("row_type"),
                    net.alias("amount_ex_tax"), disc.alias("discount_before_tax"), tax.alias("total_tax"),
                    F.col("l_quantity").alias("quantity"))
    ret = F.when(F.col("l_returnflag") == "R", F.struct(
        F.to_date("l_shipdate").alias("report_date"), F.lit("RETURN").alias("row_type"),
        (-net).alias("amount_ex_tax"), (-disc).alias("discount_before_tax"), (-tax).alias("total_tax"),
        (-F.col("l_quantity")).alias("quantity")))
    rows = j.select(F.col("l_orderkey").alias("order_id"), F.col("o_orderstatus").alias("channel"),
                    F.explode(F.array(sale, ret)).alias("r")).where("r IS NOT NULL")
    return rows.select("order_id", "channel", "r.*", F.lit("PRODUCT").alias("line_type"))


def sales_over_time(spark, d):
    return finalize(cm.sales_over_time(order_lines(spark, d), ["report_date", "channel", "row_type"]))


def order_allocation(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    a = cm.allocate(li.join(o, "l_orderkey"), "l_orderkey", "o_totalprice", "l_extendedprice", "allocated_total")
    return a.select("l_orderkey", "l_linenumber", rnd("allocated_total_weight", 6).alias("weight"),
                    rnd("allocated_total", 2).alias("allocated_total"))


def order_residuals(spark, d):
    li = load(spark, d, "lineitem")
    lines = li.select("l_orderkey", (sx(NET) + sx(TAX)).alias("amount"))
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("amount"))
    r = cm.residual(o, lines, "l_orderkey", ["amount"], eps=1e-4)
    return r.select("l_orderkey", "line_type", rnd("amount", 2).alias("residual_amount"))


def sales_by_product(spark, d):
    li = load(spark, d, "lineitem")
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    p = load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = li.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount").join(p, "l_partkey")
    # dealt by order, so that an order's lines are counted where they are joined
    lines = lines.where("l_orderkey IS NOT NULL").repartition(tasks_for(li), "l_orderkey").join(o, "l_orderkey").withColumns(
        {"gross": F.col("l_extendedprice"), "net": sx(NET)})
    return finalize(cm.sales_by_product(lines, ["p_brand"], "o_orderdate", "l_quantity", "gross", "net", "l_orderkey"))


def customer_summary(spark, d):
    o = load(spark, d, "orders")
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    s = cm.customer_summary(o, "o_custkey", "o_orderdate", "o_totalprice", "o_orderkey")
    return finalize(enrich(s, c, "o_custkey"))


# Lines per task where a step keeps few columns of them and makes no more rows.
LINES_A_TASK = 250_000


def _price_history(spark, d):
    li = load(spark, d, "lineitem")
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    n = tasks_for(li, LINES_A_TASK)
    # one cost per part and day: that day's realised unit price (ratio of sums)
    li = li.select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity").repartition(n, "l_orderkey")
    h = li.join(o.repartition(n, "l_orderkey"), "l_orderkey").select("l_partkey", F.to_date("o_orderdate").alias("effective_date"),
                                                                     "l_extendedprice", "l_quantity")
    return (h.repartition(n, "l_partkey", "effective_date").groupBy("l_partkey", "effective_date")
            .agg(F.try_divide(F.sum("l_extendedprice"), F.nullif(F.sum("l_quantity"), F.lit(0.0))).alias("unit_cost")))


def point_in_time_cost(spark, d):
    li = load(spark, d, "lineitem")
    n = tasks_for(li, LINES_A_TASK)
    facts = li.select("l_partkey", F.to_date("l_shipdate").alias("date")).repartition(n, "l_partkey", "date").distinct()
    hist = _price_history(spark, d)
    r = cm.point_in_time(facts, hist, "l_partkey", "date", "effective_date", ["unit_cost", "effective_date"],
                         distinct_points=True, tasks=n)
    return finalize(r.select("l_partkey", "date", rnd("unit_cost", 4).alias("unit_cost"),
                             (F.col("effective_date") > F.col("date")).alias("is_fallback")))


def dominant_return_flag(spark, d):
    li = load(spark, d, "lineitem")
    return cm.dominant(li, "l_orderkey", "l_returnflag", "l_quantity", out="dominant_flag")


def item_mix(spark, d):
    li = load(spark, d, "lineitem")
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    p = load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    items = li.join(o, "l_orderkey").join(p, "l_partkey").withColumns(
        {"sales": sx(NET), "voided": F.col("l_returnflag") == "R"})
    return finalize(cm.item_mix(items, ["p_type"], "o_orderdate", "l_quantity", "sales", voided="voided"))


def return_rates(spark, d):
    li = load(spark, d, "lineitem")
    p = load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = li.join(p, "l_partkey")
    r = cm.return_rates(lines, lines.where(F.col("l_returnflag") == "R"), "p_brand",
                        "l_shipdate", "l_quantity", "l_shipdate", "l_quantity")
    return finalize(r)


def inventory_cover(spark, d):
    p = load(spark, d, "part").select("p_partkey", (F.col("p_size") * 10).cast("double").alias("on_hand"))
    li = load(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_shipdate", "l_quantity")
    return cm.inventory_cover(p, li, "p_partkey", "l_shipdate", "l_quantity", "on_hand", "1998-08-01", 30)


def forecast_vs_actuals(spark, d):
    li = load(spark, d, "lineitem")
    p = load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    first = li.groupBy("l_partkey").agg(F.to_date(F.date_trunc("month", F.min("l_shipdate"))).alias("window_start"))
    fc = first.join(p, "l_partkey").select(
        "l_partkey", "window_start", F.last_day("window_start").alias("window_end"),
        F.col("p_size").cast("double").alias("forecast_units"))
    act = li.select("l_partkey", "l_shipdate", "l_quantity")
    return finalize(cm.forecast_vs_actuals(fc, act, "l_partkey", "window_start", "window_end",
                                           "l_shipdate", "l_quantity", "forecast_units", "1996-01-01"))


def sales_velocity(spark, d):
    li = load(spark, d, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    v = cm.trailing_velocity(li, ["l_partkey"], "l_shipdate", "l_quantity", days=30)
    return finalize(v.withColumn("units_30d", rnd("units_30d", 2)))


def imputed_returns(spark, d):
    li = load(spark, d, "lineitem").withColumn("revenue", sx(NET))
    ret = li.where(F.col("l_returnflag") == "R").groupBy("l_partkey").agg(F.sum("l_quantity").alias("units_returned"))
    return cm.impute_returns(ret, li, "l_partkey", "l_quantity", "revenue", "units_returned").withColumn(
        "avg_unit_price", rnd("avg_unit_price", 4))


def order_fulfillment(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    li = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    return finalize(cm.order_fulfillment(o, li, "o_orderkey", "o_orderdate", "l_shipdate", sla_days=30))


def order_book(spark, d):
    li = load(spark, d, "lineitem")
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = li.join(o, "l_orderkey").select(
        "l_orderkey", "l_quantity", F.date_add(F.to_date("o_orderdate"), 30).alias("promised_date"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("shipped"),  # NULL: nothing shipped yet
        F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") != "R"), F.col("l_quantity")).alias("invoiced"))
    return finalize(cm.order_book(lines, ["l_orderkey"], "l_quantity", "shipped", "invoiced", "promised_date",
                                  "1998-01-01"))


def contribution_margin(spark, d):
    li = load(spark, d, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("date"), "l_quantity",
                                           sx(NET).alias("net"), sx(DISC).alias("disc"), sx(TAX).alias("tax"))
    keys = ["date", "l_partkey"]
    # sales, fees and reimbursements all come from lineitem here: one roll-up, one scan
    parts = li.groupBy(*keys).agg(F.sum("net").alias("revenue"), F.sum("l_quantity").alias("units"),
                                  (-F.sum("disc")).alias("fees"), F.sum("tax").alias("reimbursed_tax"))
    h = _price_history(spark, d)
    cost = h.select("l_partkey", F.col("effective_date").alias("valid_from"), "unit_cost",
                    F.lead("effective_date").over(Window.partitionBy("l_partkey").orderBy("effective_date"))
                    .alias("valid_to"))
    out = cm.contribution_margin([parts], keys, cost, "l_partkey", "date", "units",
                                 ["revenue", "fees", "reimbursed_tax"])
    return finalize(out.select(*keys, rnd("revenue", 2).alias("revenue"), "units", rnd("fees", 2).alias("fees"),
                               rnd("reimbursed_tax", 2).alias("reimbursed_tax"), rnd("unit_cost", 4).alias("unit_cost"),
                               "cogs", "contribution_margin"))


def product_sales_over_time(spark, d):
    li = load(spark, d, "lineitem")
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_totalprice")
    j = li.join(o, "l_orderkey")
    lines = j.select(F.to_date("o_orderdate").alias("report_date"), "l_partkey", "l_quantity",
                     (sx(NET) + sx(TAX)).alias("amount"))
    per_order = j.groupBy("l_orderkey").agg(F.sum(sx(NET) + sx(TAX)).alias("amount"))
    adj = cm.residual(o.select("l_orderkey", "o_orderdate", F.col("o_totalprice").alias("amount")).drop("o_orderdate"),
                      per_order, "l_orderkey", ["amount"], eps=1e-4).join(o.select("l_orderkey", "o_orderdate"), "l_orderkey")
    adj = adj.select(F.to_date("o_orderdate").alias("report_date"), F.lit(None).cast("bigint").alias("l_partkey"),
                     F.lit(0.0).alias("l_quantity"), "amount")
    out = cm.product_sales_over_time(lines, adj, ["report_date", "l_partkey"], ["amount", "l_quantity"])
    return finalize(out)


def invoice_lines(spark, d):
    from ..operators.ledger import invoice_lines as build
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                           sx(NET).alias("net_amount"))
    hdr = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    cust = load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    part = load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return finalize(build(hdr, li, "l_orderkey", {"o_custkey": cust, "l_partkey": part}))


QUERIES = {
    "product_sales_over_time": product_sales_over_time,
    "invoice_lines": invoice_lines,
    "contribution_margin": contribution_margin,
    "order_book": order_book,
    "order_fulfillment": order_fulfillment,
    "sales_velocity": sales_velocity,
    "imputed_returns": imputed_returns,
    "sales_over_time": sales_over_time,
    "order_allocation": order_allocation,
    "order_residuals": order_residuals,
    "sales_by_product": sales_by_product,
    "customer_summary": customer_summary,
    "point_in_time_cost": point_in_time_cost,
    "dominant_return_flag": dominant_return_flag,
    "item_mix": item_mix,
    "return_rates": return_rates,
    "inventory_cover": inventory_cover,
    "forecast_vs_actuals": forecast_vs_actuals,
}

_LINES = f"""
WITH j AS (SELECT l.*, o.o_orderdate, o.o_orderstatus FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
lines AS (
  SELECT l_orderkey AS order_id, o_orderstatus AS channel, CAST(o_orderdate AS DATE) AS report_date, 'SALE' AS row_type,
         'PRODUCT' AS line_type, {NET} AS amount_ex_tax, {DISC} AS discount_before_tax,
         {TAX} AS total_tax, l_quantity AS quantity FROM j
  UNION ALL
  SELECT l_orderkey, o_orderstatus, CAST(l_shipdate AS DATE), 'RETURN', 'PRODUCT', -({NET}), -({DISC}),
         -({TAX}), -l_quantity FROM j WHERE l_returnflag = 'R')
"""

ORACLE = {
    "product_sales_over_time": f"""
WITH j AS (SELECT l.*, o.o_orderdate, o.o_totalprice, {NET} + {TAX} AS amt FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
po AS (SELECT l_orderkey, SUM(amt) AS s FROM j GROUP BY 1),
r AS (SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice - COALESCE(po.s, 0.0) AS amount FROM orders o
      LEFT JOIN po ON po.l_orderkey = o.o_orderkey),
u AS (SELECT CAST(o_orderdate AS DATE) AS report_date, l_partkey, l_quantity, amt AS amount, 'PRODUCT' AS line_type FROM j
      UNION ALL
      SELECT CAST(o_orderdate AS DATE), CAST(NULL AS BIGINT), 0.0, amount, 'ADJUSTMENT' FROM r WHERE ABS(amount) > 1e-4)
SELECT {sql_date('report_date')} AS report_date, l_partkey, line_type, ROUND(SUM(amount), 2) AS amount,
       ROUND(SUM(l_quantity), 2) AS l_quantity, COUNT(*) AS source_rows FROM u GROUP BY ALL
""",
    "invoice_lines": f"""
WITH c AS (SELECT c_custkey, MAX(c_name) AS c_name, MAX(c_mktsegment) AS c_mktsegment FROM customer GROUP BY 1),
p AS (SELECT p_partkey, MAX(p_brand) AS p_brand, MAX(p_type) AS p_type FROM part GROUP BY 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, {NET} AS net_amount, o.o_custkey,
       {sql_ts('o.o_orderdate')} AS o_orderdate, c.c_name, c.c_mktsegment, p.p_brand, p.p_type
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN c ON c.c_custkey = o.o_custkey
LEFT JOIN p ON p.p_partkey = l.l_partkey
""",
    "contribution_margin": f"""
WITH li AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS date, l_quantity, {NET} AS net, {DISC} AS disc, {TAX} AS tax
            FROM lineitem),
s AS (SELECT date, l_partkey, SUM(net) AS revenue, SUM(l_quantity) AS units FROM li GROUP BY 1, 2),
f AS (SELECT date, l_partkey, -SUM(disc) AS fees FROM li GROUP BY 1, 2),
r AS (SELECT date, l_partkey, SUM(tax) AS reimbursed_tax FROM li GROUP BY 1, 2),
m AS (SELECT date, l_partkey, COALESCE(revenue, 0) AS revenue, COALESCE(units, 0) AS units, COALESCE(fees, 0) AS fees,
             COALESCE(reimbursed_tax, 0) AS reimbursed_tax
      FROM s FULL JOIN f USING (date, l_partkey) FULL JOIN r USING (date, l_partkey)),
h AS (SELECT l.l_partkey, CAST(o.o_orderdate AS DATE) AS eff, SUM(l.l_extendedprice) / NULLIF(SUM(l.l_quantity), 0) AS cost
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2),
c AS (SELECT l_partkey, eff AS vf, LEAD(eff) OVER (PARTITION BY l_partkey ORDER BY eff) AS vt, cost FROM h),
j AS (SELECT m.*, c.cost FROM m LEFT JOIN c ON c.l_partkey = m.l_partkey AND m.date >= c.vf AND (c.vt IS NULL OR m.date < c.vt))
SELECT {sql_date('date')} AS date, l_partkey, ROUND(revenue, 2) AS revenue, units, ROUND(fees, 2) AS fees,
       ROUND(reimbursed_tax, 2) AS reimbursed_tax, ROUND(cost, 4) AS unit_cost, ROUND(units * cost, 2) AS cogs,
       ROUND(revenue + fees + reimbursed_tax - units * cost, 2) AS contribution_margin
FROM j
""",
    "order_book": f"""
WITH per_order AS (
  SELECT l.l_orderkey, SUM(l.l_quantity) AS qty_ordered, SUM(l.l_quantity) FILTER (l.l_linestatus = 'F') AS qty_shipped,
         SUM(l.l_quantity) FILTER (l.l_linestatus = 'F' AND l.l_returnflag <> 'R') AS qty_invoiced,
         MIN(CAST(o.o_orderdate AS DATE) + INTERVAL 30 DAY) AS promised_date
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY l.l_orderkey),
short AS (SELECT *, CASE WHEN qty_shipped >= qty_ordered THEN 0.0 ELSE qty_ordered - IFNULL(qty_shipped, 0.0) END AS qty_open,
                 CASE WHEN qty_invoiced >= qty_ordered THEN 0.0 ELSE qty_ordered - IFNULL(qty_invoiced, 0.0) END AS qty_uninvoiced
          FROM per_order)
SELECT l_orderkey, qty_ordered, qty_shipped, qty_invoiced, {sql_date('promised_date')} AS promised_date, qty_open, qty_uninvoiced,
       qty_open > 0 AND CAST(promised_date AS DATE) < DATE '1998-01-01' AS is_overdue
FROM short
""",
    "order_fulfillment": f"""
WITH r AS (SELECT l_orderkey, COUNT(*) AS line_count, COUNT(l_shipdate) AS shipped_lines, MIN(l_shipdate) AS f,
                  MAX(l_shipdate) AS l FROM lineitem GROUP BY 1),
j AS (SELECT o.o_orderkey, o.o_orderdate, r.line_count, r.shipped_lines, r.f, r.l,
             CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(r.l AS DATE)) AS INTEGER) AS days_to_ship
      FROM orders o LEFT JOIN r ON r.l_orderkey = o.o_orderkey)
SELECT o_orderkey, {sql_ts('o_orderdate')} AS o_orderdate, line_count, shipped_lines, {sql_ts('f')} AS first_shipped_at,
       {sql_ts('l')} AS last_shipped_at, shipped_lines = line_count AS is_fully_shipped, days_to_ship,
       COALESCE(days_to_ship <= 30, FALSE) AS sla_met FROM j
""",
    "sales_velocity": f"""
WITH s AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS date, SUM(l_quantity) AS units FROM lineitem GROUP BY 1, 2),
w AS (SELECT *, SUM(units) OVER (PARTITION BY l_partkey ORDER BY date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)
                AS u30 FROM s)
SELECT l_partkey, {sql_date('date')} AS date, units, ROUND(u30, 2) AS units_30d, ROUND(u30 / 30.0, 6) AS velocity_30d FROM w
""",
    "imputed_returns": f"""
WITH r AS (SELECT l_partkey, SUM(l_quantity) AS units_returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
p AS (SELECT l_partkey, SUM({NET}) / NULLIF(SUM(l_quantity), 0) AS avg_unit_price FROM lineitem GROUP BY 1)
SELECT r.l_partkey, r.units_returned, ROUND(p.avg_unit_price, 4) AS avg_unit_price,
       ROUND(r.units_returned * p.avg_unit_price, 2) AS imputed_return_value
FROM r LEFT JOIN p ON p.l_partkey = r.l_partkey
""",
    # long form: one row per line and measure it feeds, then one sum per measure
    "sales_over_time": _LINES + f"""
, feeds(row_type, line_type, measure) AS (VALUES
    ('SALE', 'PRODUCT', 'net_sales'), ('RETURN', 'PRODUCT', 'net_sales'), ('RETURN', 'ADJUSTMENT', 'net_sales'),
    ('RETURN', 'PRODUCT', 'returns'), ('RETURN', 'ADJUSTMENT', 'returns'),
    ('SALE', 'SHIPPING', 'shipping_charges'), ('RETURN', 'SHIPPING', 'shipping_charges'),
    ('SALE', 'DUTY', 'duties'), ('RETURN', 'DUTY', 'duties'), ('SALE', 'FEE', 'return_fees'), ('RETURN', 'FEE', 'return_fees')),
amounts AS (
  SELECT report_date, channel, l.row_type, measure, amount_ex_tax AS v FROM lines l JOIN feeds USING (row_type, line_type)
  UNION ALL SELECT report_date, channel, row_type, 'taxes', total_tax FROM lines
  UNION ALL SELECT report_date, channel, row_type, 'discounts', -GREATEST(discount_before_tax, 0.0) FROM lines
            WHERE row_type = 'SALE' AND line_type = 'PRODUCT'
  UNION ALL SELECT report_date, channel, row_type, CASE row_type WHEN 'SALE' THEN 'quantity_ordered' ELSE 'quantity_returned' END, quantity
            FROM lines WHERE line_type = 'PRODUCT' AND row_type IN ('SALE', 'RETURN')),
counted AS (SELECT report_date, channel, row_type, COUNT(DISTINCT order_id) FILTER (row_type = 'SALE') AS orders FROM lines GROUP BY ALL),
wide AS (
  SELECT report_date, channel, row_type, {", ".join(
      f"IFNULL(SUM(v) FILTER (measure = '{m}'), 0.0) AS {m}" for m in (
          "net_sales", "discounts", "returns", "shipping_charges", "duties", "return_fees", "taxes", "quantity_ordered",
          "quantity_returned"))}
  FROM amounts GROUP BY report_date, channel, row_type)
SELECT {sql_date('c.report_date')} AS report_date, c.channel, c.row_type, c.orders,
  {", ".join(f"ROUND(IFNULL({m}, 0.0), 2) AS {m}" for m in (
      "net_sales", "discounts", "returns", "shipping_charges", "duties", "return_fees", "taxes", "quantity_ordered",
      "quantity_returned"))},
  ROUND(IFNULL(net_sales - discounts - returns, 0.0), 2) AS gross_sales,
  ROUND(IFNULL(net_sales + shipping_charges + duties + return_fees + taxes, 0.0), 2) AS total_sales,
  ROUND(IFNULL(quantity_ordered + quantity_returned, 0.0), 2) AS net_quantity
FROM counted c LEFT JOIN wide w ON w.report_date IS NOT DISTINCT FROM c.report_date
  AND w.channel IS NOT DISTINCT FROM c.channel AND w.row_type IS NOT DISTINCT FROM c.row_type
""",
    "order_allocation": """
WITH j AS (SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, o.o_totalprice,
                  GREATEST(COALESCE(l.l_extendedprice, 0.0), 0.0) AS pos
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
w AS (SELECT *, SUM(pos) OVER (PARTITION BY l_orderkey) AS ws, COUNT(*) OVER (PARTITION BY l_orderkey) AS n FROM j),
s AS (SELECT *, CASE WHEN ws > 0 THEN pos / ws ELSE 1.0 / n END AS share FROM w)
SELECT l_orderkey, l_linenumber, ROUND(share, 6) AS weight, ROUND(o_totalprice * share, 2) AS allocated_total FROM s
""",
    "order_residuals": f"""
WITH lt AS (SELECT l_orderkey, SUM({NET} + {TAX}) AS amt FROM lineitem GROUP BY 1),
r AS (SELECT o.o_orderkey AS l_orderkey, o.o_totalprice - COALESCE(lt.amt, 0.0) AS amount
      FROM orders o LEFT JOIN lt ON lt.l_orderkey = o.o_orderkey)
SELECT l_orderkey, 'ADJUSTMENT' AS line_type, ROUND(amount, 2) AS residual_amount FROM r WHERE ABS(amount) > 1e-4
""",
    "sales_by_product": f"""
SELECT p.p_brand, {sql_date('CAST(o.o_orderdate AS DATE)')} AS date, COUNT(DISTINCT l.l_orderkey) AS orders,
       ROUND(SUM(l.l_quantity), 2) AS quantity, ROUND(SUM(l.l_extendedprice), 2) AS gross_sales,
       ROUND(SUM({NET}), 2) AS net_sales
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY p.p_brand, CAST(o.o_orderdate AS DATE)
""",
    "customer_summary": f"""
WITH s AS (SELECT o_custkey, COUNT(DISTINCT o_orderkey) AS order_count, ROUND(SUM(o_totalprice), 2) AS total_spent,
                  MIN(CAST(o_orderdate AS DATE)) AS f, MAX(CAST(o_orderdate AS DATE)) AS l FROM orders GROUP BY 1),
c AS (SELECT c_custkey, MAX(c_mktsegment) AS c_mktsegment FROM customer GROUP BY 1)
SELECT s.o_custkey, order_count, total_spent, {sql_date('f')} AS first_order_date, {sql_date('l')} AS last_order_date,
       ROUND(total_spent / NULLIF(order_count, 0), 2) AS average_order_value, c.c_mktsegment
FROM s LEFT JOIN c ON c.c_custkey = s.o_custkey
""",
    "point_in_time_cost": f"""
WITH h AS (SELECT l.l_partkey, CAST(o.o_orderdate AS DATE) AS eff,
                  SUM(l.l_extendedprice) / NULLIF(SUM(l.l_quantity), 0) AS cost
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2),
f AS (SELECT DISTINCT l_partkey, CAST(l_shipdate AS DATE) AS d FROM lineitem),
b AS (SELECT f.l_partkey, f.d, arg_max(h.cost, h.eff) AS cost, MAX(h.eff) AS eff
      FROM f JOIN h ON h.l_partkey = f.l_partkey AND h.eff <= f.d GROUP BY 1, 2),
e AS (SELECT l_partkey, arg_min(cost, eff) AS cost, MIN(eff) AS eff FROM h GROUP BY 1)
SELECT f.l_partkey, {sql_date('f.d')} AS date, ROUND(COALESCE(b.cost, e.cost), 4) AS unit_cost,
       COALESCE(b.eff, e.eff) > f.d AS is_fallback
FROM f LEFT JOIN b ON b.l_partkey = f.l_partkey AND b.d = f.d LEFT JOIN e ON e.l_partkey = f.l_partkey
""",
    "dominant_return_flag": """
WITH g AS (SELECT l_orderkey, l_returnflag, SUM(l_quantity) AS w FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY w DESC, l_returnflag) AS rn FROM g)
SELECT l_orderkey, l_returnflag AS dominant_flag FROM r WHERE rn = 1
""",
    "item_mix": f"""
WITH g AS (SELECT CAST(o.o_orderdate AS DATE) AS date, p.p_type, ROUND(SUM(l.l_quantity), 2) AS quantity,
                  ROUND(SUM({NET}), 2) AS item_sales
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
           WHERE NOT COALESCE(l.l_returnflag = 'R', FALSE) GROUP BY 1, 2)
SELECT {sql_date('date')} AS date, p_type, quantity, item_sales,
       ROUND(item_sales / NULLIF(SUM(item_sales) OVER (PARTITION BY date), 0), 6) AS share_of_day_sales FROM g
""",
    "return_rates": f"""
WITH lp AS (SELECT l.*, p.p_brand FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
s AS (SELECT p_brand, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, SUM(l_quantity) AS units_shipped
      FROM lp GROUP BY 1, 2),
r AS (SELECT p_brand, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, SUM(l_quantity) AS units_returned
      FROM lp WHERE l_returnflag = 'R' GROUP BY 1, 2),
f AS (SELECT COALESCE(s.p_brand, r.p_brand) AS p_brand, COALESCE(s.month, r.month) AS month, units_shipped, units_returned
      FROM s FULL JOIN r ON s.p_brand = r.p_brand AND s.month = r.month),
b AS (SELECT p_brand, MIN(month) AS s FROM f GROUP BY 1),
e AS (SELECT MAX(month) AS e FROM f),
grid AS (SELECT b.p_brand, CAST(unnest(generate_series(b.s, GREATEST(e.e, b.s), INTERVAL 1 MONTH)) AS DATE) AS month
         FROM b CROSS JOIN e)
SELECT g.p_brand, {sql_date('g.month')} AS month, COALESCE(f.units_shipped, 0.0) AS units_shipped,
       COALESCE(f.units_returned, 0.0) AS units_returned,
       ROUND(COALESCE(f.units_returned, 0.0) / NULLIF(COALESCE(f.units_shipped, 0.0), 0), 6) AS return_rate
FROM grid g LEFT JOIN f ON f.p_brand = g.p_brand AND f.month = g.month
""",
    "inventory_cover": """
WITH r AS (SELECT l_partkey, SUM(l_quantity) AS u FROM lineitem
           WHERE CAST(l_shipdate AS DATE) > DATE '1998-08-01' - INTERVAL 30 DAY AND CAST(l_shipdate AS DATE) <= DATE '1998-08-01'
           GROUP BY 1),
j AS (SELECT p.p_partkey, CAST(p.p_size * 10 AS DOUBLE) AS on_hand, COALESCE(r.u, 0.0) AS units_sold_window
      FROM part p LEFT JOIN r ON r.l_partkey = p.p_partkey)
SELECT p_partkey, on_hand, units_sold_window, ROUND(units_sold_window / 30.0, 6) AS daily_sales_rate,
       ROUND(on_hand / NULLIF(units_sold_window / 30.0, 0), 2) AS days_of_cover,
       (on_hand > 0 AND units_sold_window = 0) AS is_dead_stock
FROM j
""",
    "forecast_vs_actuals": f"""
WITH fc AS (SELECT l.l_partkey, CAST(date_trunc('month', MIN(l.l_shipdate)) AS DATE) AS window_start
            FROM lineitem l GROUP BY 1),
f AS (SELECT fc.l_partkey, window_start, last_day(window_start) AS window_end, CAST(p.p_size AS DOUBLE) AS forecast_units
      FROM fc JOIN part p ON p.p_partkey = fc.l_partkey),
a AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS ad, SUM(l_quantity) AS av FROM lineitem GROUP BY 1, 2),
s AS (SELECT f.l_partkey, f.window_start, f.window_end, SUM(a.av) AS actual FROM f JOIN a
      ON a.l_partkey = f.l_partkey AND a.ad >= f.window_start AND a.ad <= f.window_end GROUP BY 1, 2, 3),
o AS (SELECT f.*, COALESCE(s.actual, 0.0) AS actual FROM f LEFT JOIN s USING (l_partkey, window_start, window_end))
SELECT l_partkey, {sql_date('window_start')} AS window_start, {sql_date('window_end')} AS window_end, forecast_units, actual,
       ROUND(actual - forecast_units, 2) AS error,
       ROUND(ABS(actual - forecast_units) / NULLIF(actual, 0), 6) AS abs_pct_error,
       ROUND((forecast_units - actual) / NULLIF(actual, 0), 6) AS bias,
       CASE WHEN window_end < DATE '1996-01-01' THEN 'complete' WHEN window_start > DATE '1996-01-01' THEN 'future'
            ELSE 'in_progress' END AS status
FROM o
""",
}
