"""Recurring revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import ratio, rnd
from ..session import tasks_for

# Average month length in days and the snap tolerance (days).
MONTH_DAYS = 30.4375
SNAP_DAYS = 3


def _l(x):
    return [x] if isinstance(x, str) else list(x)


def _d(c):
    return F.to_date(F.col(c).cast("timestamp")) if isinstance(c, str) else c


def normalise_recurring(lines: DataFrame, start: str, end: str, amount: str) -> DataFrame:
    """Line amount / months of service (end exclusive). Months = days / 30.4375,
    snapped to the whole number when it is >= 1 and within 3 days of it."""
    days = F.datediff(_d(end), _d(start))
    m = days / F.lit(MONTH_DAYS)
    rm = F.round(m, 0)
    months = F.when((rm >= 1) & (F.abs(days - rm * F.lit(MONTH_DAYS)) <= SNAP_DAYS), rm).otherwise(m)
    return (lines.where(_d(end) > _d(start))
            .withColumns({"service_days": days, "service_months": months,
                          "monthly_amount": F.col(amount) / months}))


def mrr_by_customer_month(lines: DataFrame, keys, start: str, end: str, monthly: str, as_of) -> DataFrame:
    """MRR per key at each month's snapshot day ``least(last_day(month), as_of)``.

    A line counts when ``start <= snapshot < end``. Each line is exploded onto the
    (few) months its service spans -- bounded by its own length -- then summed per
    key x month; the grid runs from the key's first month with MRR > 0 to the
    ``as_of`` month, zero-filled and floored at 0.
    """
    keys = _l(keys)
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    months = F.sequence(F.trunc(_d(start), "month"), F.trunc(F.date_sub(_d(end), 1), "month"),
                        F.expr("INTERVAL 1 MONTH"))
    ex = lines.select(*keys, _d(start).alias("_s"), _d(end).alias("_e"), F.col(monthly).alias("_m"),
                      F.explode(months).alias("month"))
    snap = F.least(F.last_day("month"), a)
    ex = ex.where((F.col("month") <= F.trunc(a, "month")) & (F.col("_s") <= snap) & (snap < F.col("_e")))
    from .timegrid import densify
    n = tasks_for(lines)
    per = ex.repartition(n, *keys, "month").groupBy(*keys, "month").agg(F.sum("_m").alias("_mrr"))
    per = per.repartition(n, *keys)     # the grid and the windows of a key stay in this partitioning
    # grid from the first month with MRR > 0 (a window over the key's months) to as_of, one pass
    first_pos = F.min(F.when(rnd("_mrr", 2) > 0, F.col("month"))).over(Window.partitionBy(*keys))
    out = densify(per, keys, "month", [], step="month", fill=None, start=first_pos, end=F.trunc(a, "month"),
                  end_floor_to_start=False)
    return out.select(*keys, "month", F.least(F.last_day("month"), a).alias("snapshot_date"),
                      F.greatest(rnd(F.coalesce("_mrr", F.lit(0.0)), 2), F.lit(0.0)).alias("mrr"))


def classify_movement(df: DataFrame, keys, period: str = "month", value: str = "mrr") -> DataFrame:
    """New / reactivation / churn / expansion / contraction / unchanged.

    Tests in order: opening 0 & now > 0 & never before -> new; opening 0 & now > 0
    -> reactivation; opening > 0 & now 0 -> churn; then expansion / contraction /
    unchanged. Rows with opening = now = 0 are dropped; churn and contraction are
    negative amounts.
    """
    w = Window.partitionBy(*_l(keys)).orderBy(period)
    prior_max = F.max(value).over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumns({"opening_mrr": F.coalesce(F.lag(value).over(w), F.lit(0.0)),
                         "_prior_max": F.coalesce(prior_max, F.lit(0.0))})
    o, v = F.col("opening_mrr"), F.col(value)
    mtype = (F.when((o == 0) & (v > 0) & (F.col("_prior_max") == 0), "new")
             .when((o == 0) & (v > 0), "reactivation")
             .when((o > 0) & (v == 0), "churn")
             .when(v > o, "expansion").when(v < o, "contraction").otherwise("unchanged"))
    return (df.where(~((o == 0) & (v == 0)))
            .withColumns({"movement_type": mtype, "movement_amount": rnd(v - o, 2)}).drop("_prior_max"))


def mrr_bridge(movements: DataFrame, keys, period: str = "month", value: str = "mrr") -> DataFrame:
    """Per period x keys: opening, movements by type, closing, counts and rates."""
    t = F.col("movement_type")
    amt = lambda k: rnd(F.sum(F.when(t == k, F.col("movement_amount")).otherwise(0.0)), 2)
    g = movements.groupBy(period, *_l(keys)).agg(
        rnd(F.sum("opening_mrr"), 2).alias("opening_mrr"),
        amt("new").alias("new_mrr"), amt("reactivation").alias("reactivation_mrr"),
        amt("expansion").alias("expansion_mrr"), amt("contraction").alias("contraction_mrr"),
        amt("churn").alias("churned_mrr"), rnd(F.sum(value), 2).alias("closing_mrr"),
        F.count_if(F.col(value) > 0).alias("customers"),
        F.count_if(t == "new").alias("new_customers"), F.count_if(t == "churn").alias("churned_customers"),
        F.count_if(t == "reactivation").alias("reactivated_customers"))
    return g.withColumns({
        "gross_mrr_churn_rate": rnd(ratio(-(F.col("churned_mrr") + F.col("contraction_mrr")), "opening_mrr"), 6),
        "net_mrr_retention": rnd(ratio(F.col("opening_mrr") + F.col("expansion_mrr") + F.col("contraction_mrr")
                                        + F.col("churned_mrr"), "opening_mrr"), 6)})


def mrr_time_series(subs: DataFrame, key: str, month: str, amount: str) -> DataFrame:
    """Customer x month MRR carried forward over gaps, change vs previous month,
    first / last rank."""
    from .timegrid import densify
    g = subs.groupBy(key, month).agg(F.sum(amount).alias("mrr"))
    d = densify(g, key, month, [], step="month", fill=None)
    w = Window.partitionBy(key).orderBy(month)
    d = d.withColumn("mrr", F.coalesce(F.col("mrr"), F.last("mrr", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return d.withColumns({"mrr_change": F.col("mrr") - F.lag("mrr").over(w),
                          "month_number": F.row_number().over(w),
                          "months_from_latest": F.row_number().over(Window.partitionBy(key).orderBy(F.col(month).desc()))})


# Expiry reasons per churn class; any other reason (or none) is 'other'.
CHURN_CLASSES = {
    "voluntary": ["canceled"],
    "involuntary": ["nonpayment", "non_payment", "tax_location_invalid"],
    "term_ended": ["fixed_billing_cycles", "non_renewing", "nonrenewing"],
    "trial_not_converted": ["nonpayment_trial", "nonpayment_gift"],
}


def subscription_churn(subs: DataFrame, key: str, ended: str, reason: str, lines: DataFrame,
                       line_key: str, start: str, end: str, monthly: str, classes: dict | None = None) -> DataFrame:
    """Ended subscriptions, churn class by exact reason (``classes``), MRR in force the
    day before expiry (0 when none)."""
    from .joins import range_join
    ends = subs.where(F.col(ended).isNotNull()).withColumn("_day_before", F.date_sub(_d(ended), 1))
    ln = lines.select(F.col(line_key).alias(key), _d(start).alias("_ls"), _d(end).alias("_le"), F.col(monthly).alias("_m"))
    # distinct (key, day) points: two subscriptions ending together must not double the MRR
    m = range_join(ends.select(key, "_day_before").distinct(), ln, [key], "_day_before", "_ls", "_le", "[)")
    mrr = m.groupBy(key, "_day_before").agg(F.sum("_m").alias("mrr_before_churn"))
    cls = F.lit("other")
    for name, reasons in (classes or CHURN_CLASSES).items():
        cls = F.when(F.col(reason).isin(reasons), name).otherwise(cls)
    out = ends.join(mrr, [key, "_day_before"], "left").withColumn("churn_type", cls).drop("_day_before")
    return out.withColumn("mrr_before_churn", F.greatest(F.coalesce("mrr_before_churn", F.lit(0.0)), F.lit(0.0)))


def billing_by_month(parts: dict, keys: list[str]) -> DataFrame:
    """Invoiced / credited / paid / due on the union of keys (each fact rolled up first)."""
    from .aggs import rollup_facts
    out = rollup_facts(None, parts, keys, fill=0.0)
    names = [n for _, aggs in parts.values() for n in aggs]
    return out.withColumns({n: rnd(n, 2) for n in names})


def month_end_flag(df: DataFrame, entity, date: str) -> DataFrame:
    """Last available day of each month per entity."""
    w = Window.partitionBy(*_l(entity), F.trunc(F.col(date), "month"))
    return df.withColumn("is_month_end", F.col(date) == F.max(date).over(w))


def mrr_summary(series: DataFrame, month: str, canceled) -> DataFrame:
    """The MRR series summed per month: new (the customer's first month), expansion, contraction, churn (the last
    month of a canceled customer), net new MRR and its running total (one row per month)."""
    # the first month's whole MRR is new; later months carry their change
    change = F.when(F.col("month_number") == 1, F.col("mrr")).otherwise(F.col("mrr_change"))
    pick = lambda when, what: rnd(F.sum(F.when(when, what).otherwise(0.0)), 2)
    first = F.col("month_number") == 1
    g = series.groupBy(month).agg(
        pick(first, change).alias("new_mrr"), pick(~first & (change < 0), change).alias("contraction_mrr"),
        pick((F.col("months_from_latest") == 1) & canceled, -F.col("mrr")).alias("churn_mrr"),
        pick(~first & (change > 0), change).alias("expansion_mrr"))
    g = g.withColumn("net_new_mrr", rnd(F.col("new_mrr") + F.col("contraction_mrr") + F.col("churn_mrr") + F.col("expansion_mrr"), 2))
    w = Window.orderBy(month).rowsBetween(Window.unboundedPreceding, 0)   # calendar months only
    return g.withColumn("mrr_total", rnd(F.sum("net_new_mrr").over(w), 2))


def customer_churn(bridge: DataFrame, period: str = "month") -> DataFrame:
    """Customers at the start of the period (those active or churned, less the new and returned) and the share lost."""
    opening = F.col("customers") + F.col("churned_customers") - F.col("new_customers") - F.col("reactivated_customers")
    return bridge.withColumn("opening_customers", opening).withColumn(
        "customer_churn_rate", rnd(ratio("churned_customers", "opening_customers"), 6))
