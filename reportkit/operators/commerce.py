"""Commerce reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c_, classify, ratio, rnd
from ..session import tasks_for
from .joins import asof_join, join_ns, merge_full, range_join
from .windows import pick_one


def _l(x):
    return [x] if isinstance(x, str) else list(x)


def sale_row_type(kind) -> Column:
    """D11 row typing: ORDER/UPDATE -> SALE, RETURN -> RETURN, CANCELLATION kept, others NULL (dropped)."""
    k = F.upper(c_(kind))
    return classify([(k.isin("ORDER", "UPDATE", "SALE"), "SALE"), (k.isin("RETURN", "REFUND"), "RETURN"),
                     (k.isin("CANCELLATION", "CANCEL"), "CANCELLATION")], None)


def edit_flags(happened_at, order_created_at, edit_window_seconds: int = 90) -> Column:
    """A post-purchase edit within the window counts as the original order (checkout edit)."""
    return F.timestamp_diff("SECOND", c_(order_created_at), c_(happened_at)) <= edit_window_seconds


def sales_over_time(lines: DataFrame, grain: list[str], row_type: str = "row_type",
                    line_type: str = "line_type", order_id: str = "order_id",
                    amount: str = "amount_ex_tax", discount: str = "discount_before_tax",
                    tax: str = "total_tax", quantity: str = "quantity",
                    is_edit: str | None = None, digits: int = 2) -> DataFrame:
    """The sales equation per grain (which includes the row type).

    Signed money: returns are negative, so ``net = gross + discounts + returns``
    and ``total = net + shipping + duties + return fees + taxes``. One hash
    aggregate of conditional sums -- partial aggregation handles any hot day.
    """
    rt, lt = F.col(row_type), F.col(line_type)
    sale_prod = (rt == "SALE") & (lt == "PRODUCT")
    ret_money = (rt == "RETURN") & lt.isin("PRODUCT", "ADJUSTMENT")
    not_edit = F.lit(True) if is_edit is None else ~F.coalesce(F.col(is_edit), F.lit(False))
    z = F.lit(0.0)
    s = lambda cond, col: F.sum(F.when(cond, F.col(col)).otherwise(z))
    g = lines.groupBy(*grain).agg(
        F.count_distinct(F.when((rt == "SALE") & not_edit, F.col(order_id))).alias("orders"),
        (s(sale_prod, amount) + s(ret_money, amount)).alias("net_sales"),
        (-F.sum(F.when(sale_prod, F.greatest(F.col(discount), z)).otherwise(z))).alias("discounts"),
        s(ret_money, amount).alias("returns"),
        s(lt == "SHIPPING", amount).alias("shipping_charges"),
        s(lt == "DUTY", amount).alias("duties"),
        s(lt == "FEE", amount).alias("return_fees"),
        F.sum(F.coalesce(F.col(tax), z)).alias("taxes"),
        s(sale_prod, quantity).alias("quantity_ordered"),
        s((rt == "RETURN") & (lt == "PRODUCT"), quantity).alias("quantity_returned"))
    g = g.withColumns({
        "gross_sales": F.col("net_sales") - F.col("discounts") - F.col("returns"),
        "total_sales": F.col("net_sales") + F.col("shipping_charges") + F.col("duties")
        + F.col("return_fees") + F.col("taxes"),
        "net_quantity": F.col("quantity_ordered") + F.col("quantity_returned")})
    money = ["net_sales", "discounts", "returns", "shipping_charges", "duties", "return_fees", "taxes",
             "gross_sales", "total_sales", "quantity_ordered", "quantity_returned", "net_quantity"]
    return g.withColumns({m: rnd(F.col(m), digits) for m in money})


def allocate(lines: DataFrame, order_key, amount: str, weight: str, out: str) -> DataFrame:
    """Distribute an order-level amount to lines by weight share.

    ``w = max(v,0) / sum(max(v,0))`` inside the order; an order whose base is 0
    splits evenly (1/n), so line values always reproduce the order total. The
    per-order totals are a hash aggregate joined back (skew-split by AQE), not a
    window that would sort a huge order in one task.
    """
    keys = _l(order_key)
    pos = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    tot = lines.groupBy(*keys).agg(F.sum(pos).alias("_ws"), F.count(F.lit(1)).alias("_n"))
    j = lines.join(tot, keys)
    share = F.when(F.col("_ws") > 0, pos / F.col("_ws")).otherwise(F.lit(1.0) / F.col("_n"))
    return j.withColumns({f"{out}_weight": share, out: F.col(amount) * share}).drop("_ws", "_n")


def residual(order_totals: DataFrame, line_totals: DataFrame, on, measures: list[str],
             eps: float = 1e-4, label_col: str = "line_type", label: str = "ADJUSTMENT") -> DataFrame:
    """Order-level total minus what the lines explain -> explicit adjustment rows."""
    keys = _l(on)
    lt = line_totals.groupBy(*keys).agg(*[F.sum(m).alias(f"_l_{m}") for m in measures])
    j = order_totals.join(lt, keys, "left")
    diffs = {m: F.col(m) - F.coalesce(F.col(f"_l_{m}"), F.lit(0.0)) for m in measures}
    out = j.select(*keys, *[d.alias(m) for m, d in diffs.items()])
    keep = None
    for m in measures:
        cond = F.abs(F.col(m)) > eps
        keep = cond if keep is None else keep | cond
    return out.where(keep).withColumn(label_col, F.lit(label))


def dominant(df: DataFrame, keys, type_col: str, weight: str, out: str = "dominant_type") -> DataFrame:
    """The type with the most weight per key; ties -> alphabetically first type."""
    g = df.groupBy(*_l(keys), type_col).agg(F.sum(weight).alias("_w"))
    return pick_one(g, keys, ["-_w", type_col]).select(*_l(keys), F.col(type_col).alias(out))


def point_in_time(facts: DataFrame, history: DataFrame, on, date: str, eff: str, cols: list[str],
                  fallback: str | None = "earliest", distinct_points: bool = False, tasks: int | None = None) -> DataFrame:
    """Value effective on the fact's day (effective_ts < day + 1, newest first);
    with no earlier row, the earliest later one (``fallback='earliest'``)."""
    from pyspark.sql.types import DateType
    h = history.withColumn("_eff_day", F.to_date(F.col(eff).cast("timestamp")))
    h = h.drop(eff).withColumnRenamed("_eff_day", eff)
    if isinstance(facts.schema[date].dataType, DateType):
        return asof_join(facts, h, on, date, eff, cols, fallback, distinct_points=distinct_points, tasks=tasks)
    f = facts.withColumn("_day", F.to_date(F.col(date).cast("timestamp")))
    return asof_join(f, h, on, "_day", eff, cols, fallback, tasks=tasks).drop("_day")


def contribution_margin(parts: list[DataFrame], keys: list[str], cost: DataFrame, sku: str, date: str,
                        units: str, revenue_cols: list[str], unit_cost: str = "unit_cost",
                        valid_from: str = "valid_from", valid_to: str = "valid_to",
                        subset_parts: list | None = None) -> DataFrame:
    """Full-outer merge of sales/fees/reimbursements, minus COGS at the cost valid on
    the day (``[from, to)``); margin NULL when no cost is known.

    ``subset_parts = [(df, subset_keys)]`` are full-outer joined afterwards on fewer
    keys (reimbursements carry no marketplace): such a row meets
    every merged row sharing its subset key, and stands alone (other keys NULL) when
    none does.
    """
    merged = merge_full(parts, keys, fill=None)
    for df, sub in subset_parts or []:
        merged = merged.join(df, list(sub), "full")
    measures = [c for c, t in merged.dtypes if c not in keys and (t in ("double", "float", "int", "bigint")
                                                                  or t.startswith("decimal"))]
    merged = merged.withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in measures})
    c = cost.select(F.col(sku).alias("_sku"), valid_from, valid_to, unit_cost)
    base = range_join(merged.withColumn("_sku", F.col(sku)), c, ["_sku"], date, valid_from, valid_to, "[)",
                      how="left").drop("_sku", valid_from, valid_to)
    rev = None
    for r in revenue_cols:
        rev = F.col(r) if rev is None else rev + F.col(r)
    return base.withColumns({
        "cogs": rnd(F.col(units) * F.col(unit_cost), 2),
        "contribution_margin": rnd(rev - F.col(units) * F.col(unit_cost), 2)})


def impute_returns(returns: DataFrame, sales: DataFrame, key, units: str, revenue: str,
                   returned_units: str) -> DataFrame:
    """Returned units valued at the key's average realised price (ratio of sums)."""
    price = sales.groupBy(*_l(key)).agg(ratio(F.sum(revenue), F.sum(units)).alias("avg_unit_price"))
    return returns.join(price, _l(key), "left").withColumn(
        "imputed_return_value", rnd(F.col(returned_units) * F.col("avg_unit_price"), 2))


def sales_by_product(lines: DataFrame, product: list[str], date: str, quantity: str, gross: str,
                     net: str, order_id: str) -> DataFrame:
    """Product x day sales on the order date."""
    return lines.groupBy(*product, F.to_date(F.col(date).cast("timestamp")).alias("date")).agg(
        F.count_distinct(order_id).alias("orders"), rnd(F.sum(quantity), 2).alias("quantity"),
        rnd(F.sum(gross), 2).alias("gross_sales"), rnd(F.sum(net), 2).alias("net_sales"))


def customer_summary(orders: DataFrame, customer: str, ts: str, amount: str, order_id: str) -> DataFrame:
    """Orders, spend, AOV, first / last order per customer."""
    g = orders.groupBy(customer).agg(
        F.count_distinct(order_id).alias("order_count"), rnd(F.sum(amount), 2).alias("total_spent"),
        F.min(F.to_date(F.col(ts).cast("timestamp"))).alias("first_order_date"),
        F.max(F.to_date(F.col(ts).cast("timestamp"))).alias("last_order_date"))
    return g.withColumn("average_order_value", rnd(ratio("total_spent", "order_count"), 2))


def inventory_cover(stock: DataFrame, sales: DataFrame, key, date: str, qty: str, on_hand: str,
                    as_of, window_days: int = 30) -> DataFrame:
    """Stock / recent daily sales rate -> days of cover; dead stock = stock, no sales."""
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    d = F.to_date(F.col(date).cast("timestamp"))
    recent = (sales.where((d > F.date_sub(a, window_days)) & (d <= a))
              .groupBy(*_l(key)).agg(F.sum(qty).alias("units_sold_window")))
    j = stock.join(recent, _l(key), "left").withColumn("units_sold_window",
                                                      F.coalesce("units_sold_window", F.lit(0.0)))
    rate = F.col("units_sold_window") / F.lit(float(window_days))
    return j.withColumns({
        "daily_sales_rate": rnd(rate, 6),
        "days_of_cover": rnd(ratio(F.col(on_hand), rate), 2),
        "is_dead_stock": (F.col(on_hand) > 0) & (F.col("units_sold_window") == 0)})


def trailing_velocity(sales: DataFrame, keys: list[str], date: str, qty: str, days: int = 30,
                      stock: DataFrame | None = None) -> DataFrame:
    """Trailing-N-calendar-day units and rate at each date of a key union spine."""
    from .sets import key_union
    from .windows import trailing_agg
    n = tasks_for(sales)
    s = sales.select(*keys, F.to_date(F.col(date).cast("timestamp")).alias("date"), F.col(qty).alias("_q"))
    s = s.repartition(n, *keys, "date").groupBy(*keys, "date").agg(F.sum("_q").alias("units"))
    if stock is None:       # every row finds its own units, unless a key is NULL
        found = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys + ["date"]])
        j = s.withColumn("units", F.when(found, F.col("units")))
    else:
        j = key_union([s, stock], keys + ["date"]).join(s, keys + ["date"], "left")
    j = j.repartition(n, *keys).withColumn("units", F.coalesce("units", F.lit(0.0)))
    j = trailing_agg(j, keys, "date", "units", days, "sum", True, out=f"units_{days}d")
    return j.withColumn(f"velocity_{days}d", rnd(F.col(f"units_{days}d") / F.lit(float(days)), 6))


def forecast_vs_actuals(forecasts: DataFrame, actuals: DataFrame, on, lo: str, hi: str,
                        act_date: str, act_value: str, forecast_col: str, as_of) -> DataFrame:
    """Actuals summed over each forecast window ``[lo, hi]`` vs the forecast."""
    keys = _l(on)
    a = actuals.groupBy(*keys, F.to_date(F.col(act_date).cast("timestamp")).alias("_ad")).agg(
        F.sum(act_value).alias("_av"))
    # a forecast row is identified by (keys, lo, hi)
    m = range_join(a, forecasts.select(*keys, lo, hi), keys, "_ad", lo, hi, "[]")
    sums = m.groupBy(*keys, lo, hi).agg(F.sum("_av").alias("actual"))
    out = forecasts.join(sums, keys + [lo, hi], "left").withColumn("actual", F.coalesce("actual", F.lit(0.0)))
    asof = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return out.withColumns({
        "error": rnd(F.col("actual") - F.col(forecast_col), 2),
        "abs_pct_error": rnd(ratio(F.abs(F.col("actual") - F.col(forecast_col)), F.col("actual")), 6),
        "bias": rnd(ratio(F.col(forecast_col) - F.col("actual"), F.col("actual")), 6),
        "status": F.when(F.col(hi) < asof, "complete").when(F.col(lo) > asof, "future").otherwise("in_progress")})


def item_mix(items: DataFrame, keys: list[str], day: str, qty: str, sales: str,
             voided: str | None = None) -> DataFrame:
    """Quantity, sales and share of the day's item sales; voids excluded."""
    from .windows import share_of
    src = items if voided is None else items.where(~F.coalesce(F.col(voided), F.lit(False)))
    g = src.groupBy(F.to_date(F.col(day).cast("timestamp")).alias("date"), *keys).agg(
        rnd(F.sum(qty), 2).alias("quantity"), rnd(F.sum(sales), 2).alias("item_sales"))
    return share_of(g, ["date"], "item_sales", out="share_of_day_sales", digits=6)


def order_fulfillment(orders: DataFrame, lines: DataFrame, order_key: str, ordered_at: str,
                      shipped_at: str, sla_days: int = 2) -> DataFrame:
    """Per order lines, shipped lines, first / last shipment, SLA met."""
    rolled = lines.groupBy(order_key).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(F.col(shipped_at).isNotNull()).alias("shipped_lines"),
        F.min(shipped_at).alias("first_shipped_at"), F.max(shipped_at).alias("last_shipped_at"))
    j = orders.join(rolled, order_key, "left")
    days = F.datediff(F.to_date(F.col("last_shipped_at").cast("timestamp")), F.to_date(F.col(ordered_at).cast("timestamp")))
    return j.withColumns({
        "is_fully_shipped": F.col("shipped_lines") == F.col("line_count"),
        "days_to_ship": days,
        "sla_met": F.coalesce(days <= sla_days, F.lit(False))})


def order_book(lines: DataFrame, keys: list[str], ordered: str, shipped: str, invoiced: str,
               promised: str | None = None, as_of=None) -> DataFrame:
    """Ordered vs shipped vs invoiced; open = ordered - shipped and uninvoiced = ordered -
    invoiced (NULL counts as 0, never below 0); overdue flag."""
    g = lines.groupBy(*keys).agg(F.sum(ordered).alias("qty_ordered"), F.sum(shipped).alias("qty_shipped"),
                                 F.sum(invoiced).alias("qty_invoiced"),
                                 *([F.min(promised).alias("promised_date")] if promised else []))
    short = lambda done: F.greatest(F.coalesce("qty_ordered", F.lit(0.0)) - F.coalesce(done, F.lit(0.0)), F.lit(0.0))
    g = g.withColumns({"qty_open": short("qty_shipped"), "qty_uninvoiced": short("qty_invoiced")})
    if promised and as_of is not None:
        a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
        g = g.withColumn("is_overdue", (F.col("qty_open") > 0) & (F.to_date("promised_date") < a))
    return g


def return_rates(shipped: DataFrame, returned: DataFrame, sku: str, date_s: str, qty_s: str,
                 date_r: str, qty_r: str, end=None) -> DataFrame:
    """Shipped and returned units per SKU x month on a grid, return rate."""
    from .timegrid import densify
    m = lambda c: F.to_date(F.date_trunc("month", F.col(c).cast("timestamp")))
    s = shipped.groupBy(sku, m(date_s).alias("month")).agg(F.sum(qty_s).alias("units_shipped"))
    r = returned.groupBy(sku, m(date_r).alias("month")).agg(F.sum(qty_r).alias("units_returned"))
    facts = join_ns(s, r, [sku, "month"], "full")
    g = densify(facts, sku, "month", ["units_shipped", "units_returned"], end=end, step="month", fill=0.0)
    return g.withColumn("return_rate", rnd(ratio("units_returned", "units_shipped"), 6))


def shipment_lanes(shipments: DataFrame, lane: list[str], date: str, weight: str, cost: str,
                   shipped: str, estimated_days: str | None = None) -> DataFrame:
    """Per lane x month: shipments, weight, cost, cost per kg, mean transit days
    and the share delivered within the estimate."""
    month = F.to_date(F.date_trunc("month", F.col(date).cast("timestamp")))
    transit = F.datediff(F.to_date(F.col(shipped).cast("timestamp")), F.to_date(F.col(date).cast("timestamp")))
    aggs = [F.count(F.lit(1)).alias("shipments"), rnd(F.sum(weight), 2).alias("total_weight"),
            rnd(F.sum(cost), 2).alias("total_cost"), rnd(F.avg(transit), 4).alias("avg_transit_days")]
    if estimated_days:
        aggs.append(F.count_if(transit <= F.col(estimated_days)).alias("on_time_shipments"))
    g = shipments.groupBy(*lane, month.alias("month")).agg(*aggs)
    g = g.withColumn("cost_per_kg", rnd(ratio("total_cost", "total_weight"), 4))
    if estimated_days:
        g = g.withColumn("on_time_rate", rnd(ratio("on_time_shipments", "shipments"), 6))
    return g


# Claim outcome groups.
CLAIM_OUTCOMES = {"resolved": ["F"], "open": ["O"]}


def claims_by_month(claims: DataFrame, base: DataFrame, dims: list[str], date: str, outcome: str,
                    base_date: str, end=None) -> DataFrame:
    """Claims with outcome groups per dims x month on a grid, claim rate over the
    base volume (e.g. shipped lines) of the same dims x month."""
    from .timegrid import densify
    m = lambda c: F.to_date(F.date_trunc("month", F.col(c).cast("timestamp")))
    grp = F.when(F.col(outcome).isin(CLAIM_OUTCOMES["resolved"]), "resolved").when(
        F.col(outcome).isin(CLAIM_OUTCOMES["open"]), "open").otherwise("other")
    c = claims.groupBy(*dims, m(date).alias("month")).agg(
        F.count(F.lit(1)).alias("claims"), F.count_if(grp == "resolved").alias("resolved_claims"),
        F.count_if(grp == "open").alias("open_claims"))
    b = base.groupBy(*dims, m(base_date).alias("month")).agg(F.count(F.lit(1)).alias("base_volume"))
    g = densify(join_ns(c, b, dims + ["month"], "full"), dims, "month",
                ["claims", "resolved_claims", "open_claims", "base_volume"], end=end, step="month")
    return g.withColumn("claim_rate", rnd(ratio("claims", "base_volume"), 6))


def product_sales_over_time(lines: DataFrame, adjustments: DataFrame, grain: list[str], measures: list[str]) -> DataFrame:
    """Line-grain money that reconciles with the order-level report: product line
    rows plus explicit adjustment rows (NULL product, from D14 residuals) stacked into
    one schema (U1), then summed at the grain."""
    from .sets import union_events
    u = union_events({"PRODUCT": lines, "ADJUSTMENT": adjustments}, label="line_type")
    return u.groupBy(*grain, "line_type").agg(
        *[rnd(F.sum(m), 2).alias(m) for m in measures], F.count(F.lit(1)).alias("source_rows"))


def repoint_refunds(orders: DataFrame, order_id: str, parent_id: str, out: str = "report_order_id") -> DataFrame:
    """D11 variant: refunds stored as child orders are re-pointed to their parent order."""
    return orders.withColumn(out, F.coalesce(F.col(parent_id), F.col(order_id)))


def drop_declined_refunds(lines: DataFrame, refund_id: str, declined: str) -> DataFrame:
    """D11 variant: a refund whose lines are *all* declined is dropped (LOGICAL_AND per refund)."""
    bad = (lines.groupBy(refund_id).agg(F.bool_and(F.coalesce(F.col(declined), F.lit(False))).alias("_all"))
           .where("_all").select(refund_id))
    return lines.join(bad, refund_id, "left_anti")


def cap_cancelled(lines: DataFrame, cancelled: str, ordered: str) -> DataFrame:
    """D11 variant: cancelled units never exceed ordered units."""
    return lines.withColumn(cancelled, F.least(F.col(cancelled), F.col(ordered)))


def sign_credit_notes(lines: DataFrame, cols: list[str], is_credit) -> DataFrame:
    """D11 variant (P12): credit notes are negative orders."""
    return lines.withColumns({c: F.when(is_credit, -F.abs(F.col(c))).otherwise(F.col(c)) for c in cols})


def fulfillment_by_day(shipments: DataFrame, dims: list[str], shipped: str, shipment, order: str, units: str,
                       label_cost: str, refunded, end=None) -> DataFrame:
    """Per day x dims on a grid: shipments, orders shipped, units, labels bought and refunded, label cost
    (refunded labels cost nothing). ``shipments`` has one row per shipped line with its label."""
    from .timegrid import densify
    day = F.to_date(F.col(shipped).cast("timestamp"))
    names = ["shipments", "orders_shipped", "units_shipped", "labels", "refunded_labels", "label_cost"]
    g = shipments.where(F.col(shipped).isNotNull()).groupBy(*dims, day.alias("date")).agg(
        F.count_distinct(shipment).alias("shipments"), F.count_distinct(order).alias("orders_shipped"),
        F.sum(units).alias("units_shipped"), F.count_if(~refunded).alias("labels"), F.count_if(refunded).alias("refunded_labels"),
        rnd(F.sum(F.when(~refunded, F.col(label_cost)).otherwise(0.0)), 2).alias("label_cost"))
    return densify(g, dims, "date", names, end=end)


def lane_costs(shipments: DataFrame, lane: list[str], carrier: str, date: str, cost: str, weight: str, delivered: str,
               promised: str, as_of, unknown: str = "(unknown carrier)") -> DataFrame:
    """Per lane x carrier: first and last shipment, shipments (all, last 90 days), cost, weight, cost per shipment
    with a cost and per kg with a weight, mean transit days, on-time rate among shipments with both dates."""
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    day = lambda c: F.to_date(F.col(c).cast("timestamp"))
    priced = F.col(cost).isNotNull() & (F.col(weight) > 0)
    on_time = day(delivered) <= day(promised)
    g = shipments.groupBy(*lane, F.coalesce(F.col(carrier), F.lit(unknown)).alias(carrier)).agg(
        F.min(day(date)).alias("first_shipment_date"), F.max(day(date)).alias("last_shipment_date"),
        F.count(F.lit(1)).alias("shipments"), F.count_if(day(date) >= F.date_sub(a, 90)).alias("shipments_last_90_days"),
        F.sum(cost).alias("_cost"), F.count(cost).alias("_with_cost"), F.sum(weight).alias("weight"),
        F.sum(F.when(priced, F.col(cost))).alias("_pc"), F.sum(F.when(priced, F.col(weight))).alias("_pw"),
        rnd(F.avg(F.datediff(day(delivered), day(date))), 4).alias("avg_transit_days"),
        F.count_if(on_time).alias("_on"), F.count(on_time).alias("_judged"))
    return g.withColumns({"cost": rnd("_cost", 2), "cost_per_shipment": rnd(ratio("_cost", "_with_cost"), 4),
                          "cost_per_kg": rnd(ratio("_pc", "_pw"), 4), "on_time_rate": rnd(ratio("_on", "_judged"), 6)}) \
        .drop("_cost", "_with_cost", "_pc", "_pw", "_on", "_judged")


def carrier_costs(shipments: DataFrame, dims: list[str], date: str, cost: str, weight: str, cancelled, as_of) -> DataFrame:
    """Per dims x month on a grid to ``as_of`` or the last shipment: shipments, cancelled ones, cost, weight
    of those not cancelled, cost per kg."""
    from .timegrid import densify
    a = F.trunc(F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of, "month")
    month = F.to_date(F.date_trunc("month", F.col(date).cast("timestamp")))
    g = shipments.where(F.col(date).isNotNull()).groupBy(*dims, month.alias("month")).agg(
        F.count_if(~cancelled).alias("shipments"), F.count_if(cancelled).alias("cancelled_shipments"),
        rnd(F.sum(cost), 2).alias("freight_cost"), F.sum(F.when(~cancelled, F.col(weight))).alias("weight"))
    out = densify(g, dims, "month", ["shipments", "cancelled_shipments", "freight_cost", "weight"], end=a, step="month")
    return out.withColumn("cost_per_kg", rnd(ratio("freight_cost", "weight"), 4))
