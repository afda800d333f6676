"""D88-D107: work, HR and operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio, rnd


def _d(c):
    return F.to_date(F.col(c).cast("timestamp")) if isinstance(c, str) else c


def workload(tasks: DataFrame, dims: list[str], due: str, is_open, as_of, soon_days: int = 7) -> DataFrame:
    """Open, overdue and due-soon items per dims as of ``as_of``."""
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    d = _d(due)
    return tasks.where(is_open).groupBy(*dims).agg(
        F.count(F.lit(1)).alias("open_items"), F.count_if(d < a).alias("overdue_items"),
        F.count_if((d >= a) & (d <= F.date_add(a, soon_days))).alias("due_soon_items"),
        F.count_if(d.isNull()).alias("no_due_date_items"))


def completion_stats(tasks: DataFrame, dims: list[str], created: str, completed: str, due: str) -> DataFrame:
    """Completed per day, on-time share, mean days to complete."""
    c = _d(completed)
    days = F.datediff(c, _d(created))
    g = tasks.where(F.col(completed).isNotNull()).groupBy(c.alias("date"), *dims).agg(
        F.count(F.lit(1)).alias("completed"), F.count_if(c <= _d(due)).alias("completed_on_time"),
        rnd(F.avg(days), 4).alias("avg_days_to_complete"))
    return g.withColumn("on_time_rate", rnd(ratio("completed_on_time", "completed"), 6))


def flow_by_day(entities: DataFrame, ts_measures: dict, dims: list[str]) -> DataFrame:
    """Entity dated on each lifecycle timestamp."""
    from .timegrid import events_from_timestamps
    return events_from_timestamps(entities, ts_measures, dims)


def area_month(facts: DataFrame, tree: DataFrame, node: str, month: str, measure: str) -> DataFrame:
    """D100: facts attached to a node are rolled up to the node's top-level area (tree
    flattened with R1), then share of the month and change vs the previous calendar month."""
    from .windows import period_change, share_of
    g = (facts.join(tree.select(F.col("node_id").alias(node), F.col("root_name").alias("area")), node, "left")
         .groupBy("area", month).agg(F.sum(measure).alias(measure)))
    g = share_of(g, [month], measure, out="share_of_month", digits=6)
    g = period_change(g, ["area"], month, [measure], calendar="month", digits=6)
    return g.withColumns({measure: rnd(measure, 2), f"prev_{measure}": rnd(f"prev_{measure}", 2),
                          f"{measure}_change": rnd(f"{measure}_change", 2)})


def labour_vs_sales(sales: DataFrame, labour: DataFrame, on, sales_col: str, cost_col: str, hours_col: str) -> DataFrame:
    """Labour % of sales and sales per labour hour, keeping days with one side only."""
    from .joins import merge_full
    m = merge_full([sales, labour], on, fill=0)
    return m.withColumns({"labour_pct": rnd(ratio(cost_col, sales_col, scale=100), 4),
                          "sales_per_labour_hour": rnd(ratio(sales_col, hours_col), 4)})


def budget_vs_actual(budget: DataFrame, actuals: DataFrame, on, lo: str, hi: str, date: str, value: str,
                     budget_col: str) -> DataFrame:
    """Daily actuals summed into budget windows ``[lo, hi]``, variance."""
    from .joins import range_join
    keys = [on] if isinstance(on, str) else list(on)
    a = actuals.groupBy(*keys, _d(date).alias("_day")).agg(F.sum(value).alias("_v"))
    m = range_join(a, budget.select(*keys, lo, hi), keys, "_day", lo, hi, "[]")
    s = m.groupBy(*keys, lo, hi).agg(F.sum("_v").alias("actual"))
    j = budget.join(s, keys + [lo, hi], "left").withColumn("actual", rnd(F.coalesce("actual", F.lit(0.0)), 2))
    return j.withColumns({"variance": rnd(F.col("actual") - F.col(budget_col), 2),
                          "variance_pct": rnd(ratio(F.col("actual") - F.col(budget_col), budget_col), 6)})


def assignments(items: DataFrame, item: str, people_col: str, pattern: str | None = None,
                path: str | None = None, kind: str | None = None, person: str = "$", kinds: list[str] | None = None) -> DataFrame:
    """One row per item x person from a list held in a column (every regex match via ``pattern``, or
    JSON text exploded at ``path``: ``person`` is the path of the name in an entry, ``kind`` that of its type,
    and only entries of ``kinds`` count), de-duplicated."""
    if pattern:
        return items.select(item, F.explode(F.array_distinct(F.regexp_extract_all(F.col(people_col), F.lit(pattern), 0))).alias("person")).distinct()
    from .arrays import explode_json
    ex = explode_json(items.select(item, people_col), people_col, path=path, pos=False, out="_entry")
    if kind:
        ex = ex.where(F.try_variant_get("_entry", kind, "string").isin(list(kinds or [])))
    return ex.select(item, F.try_variant_get("_entry", person, "string").alias("person")).where("person IS NOT NULL").distinct()


def dependency_counts(tasks: DataFrame, deps: DataFrame, key: str, dep_status: str, open_values: list[str]) -> DataFrame:
    """Dependencies per task and blocker state: none / unknown (a dependency with no
    status) / blocked (any open) / clear."""
    d = deps.groupBy(key).agg(F.count(F.lit(1)).alias("dependencies"),
                              F.count_if(F.col(dep_status).isin(open_values)).alias("open_dependencies"),
                              F.count_if(F.col(dep_status).isNull()).alias("_unknown"))
    j = tasks.join(d, key, "left").fillna({"dependencies": 0, "open_dependencies": 0, "_unknown": 0})
    state = (F.when(F.col("dependencies") == 0, "none").when(F.col("_unknown") > 0, "unknown")
             .when(F.col("open_dependencies") > 0, "blocked").otherwise("clear"))
    return j.withColumn("blocker_state", state).drop("_unknown")


def checklist_progress(items: DataFrame, key: str, resolved) -> DataFrame:
    """Checklist items and the resolved share per task."""
    g = items.groupBy(key).agg(F.count(F.lit(1)).alias("checklist_items"), F.count_if(resolved).alias("resolved_items"))
    return g.withColumn("resolved_share", rnd(ratio("resolved_items", "checklist_items"), 6))


def incident_response(events: DataFrame, entity: str, ts: str, kind: str, incident: str, ack_kinds: list[str],
                      resolve_kinds: list[str], order: list[str] | None = None, bucket=None) -> DataFrame:
    """Each incident event is acknowledged by the entity's next event of an ack kind
    and resolved by the next of a resolve kind (W16, two-level per entity x hour so a
    noisy entity is not one task); per day: incidents, mean minutes to acknowledge
    (MTTA) and to resolve (MTTR), unresolved count."""
    from .windows import seq_next_when_many
    o = [ts] + list(order or [])
    bk = bucket if bucket is not None else F.date_trunc("hour", F.col(ts).cast("timestamp"))
    e = seq_next_when_many(events, entity, o, {"_ack": F.col(kind).isin(ack_kinds),
                                               "_res": F.col(kind).isin(resolve_kinds)}, ts, bk)
    inc = e.where(F.col(kind) == incident)
    mins = lambda c: F.timestamp_diff("MINUTE", F.col(ts), F.col(c))
    return inc.groupBy(F.to_date(F.col(ts).cast("timestamp")).alias("date")).agg(
        F.count(F.lit(1)).alias("incidents"), rnd(F.avg(mins("_ack")), 4).alias("mtta_minutes"),
        rnd(F.avg(mins("_res")), 4).alias("mttr_minutes"), F.count_if(F.col("_res").isNull()).alias("unresolved"))


def headcount(spans: DataFrame, person: str, org: str, start: str, end: str, as_of,
              history: DataFrame | None = None, hist_ts: str | None = None, tasks: int | None = None) -> DataFrame:
    """Per month x org: headcount at the start (started <= previous month end and not
    ended by it) and at the end of the month, hires and leavers inside the month,
    turnover = leavers / mean(start, end). Each person is exploded onto the months of
    their own span only.

    With ``history`` (person, ``hist_ts``, ``org``; one row per person and day) the
    org is time-varying: the latest history row at ``least(month end, end date)``
    (J6 as-of join, its steps dealt to ``tasks`` partitions); otherwise ``spans[org]`` is used.
    """
    from .joins import asof_join
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    s, e = F.to_date(F.col(start).cast("timestamp")), F.to_date(F.col(end).cast("timestamp"))
    cols = [person] + ([org] if history is None else [])
    p = spans.select(*cols, s.alias("_s"), e.alias("_e"))
    p = p.where(F.col("_s") <= F.last_day(a))  # a later start has no month on the report yet
    months = F.sequence(F.trunc("_s", "month"),
                        F.greatest(F.trunc("_s", "month"), F.trunc(F.least(F.coalesce(F.add_months("_e", 1), a), a), "month")),
                        F.expr("INTERVAL 1 MONTH"))
    ex = p.select(*cols, "_s", "_e", F.explode(months).alias("month"))
    if history is not None:
        ex = ex.withColumn("_ref", F.least(F.last_day("month"), F.coalesce("_e", F.last_day("month"))))
        h = history.select(person, F.to_date(F.col(hist_ts).cast("timestamp")).alias("_eff"), org)
        # a person has one row a month, so few per day; a row without a person has no history
        ex = asof_join(ex, h, person, "_ref", "_eff", [org], fallback=None, distinct_points=True, tasks=tasks)
        ex = ex.withColumn(org, F.when(F.col(person).isNotNull(), F.col(org)))
    prev_end = F.date_sub(F.col("month"), 1)
    mend = F.last_day("month")
    g = ex.groupBy("month", org).agg(
        F.count_if((F.col("_s") <= prev_end) & (F.col("_e").isNull() | (F.col("_e") > prev_end))).alias("headcount_start"),
        F.count_if((F.col("_s") <= mend) & (F.col("_e").isNull() | (F.col("_e") > mend))).alias("headcount_end"),
        F.count_if(F.trunc("_s", "month") == F.col("month")).alias("hires"),
        F.count_if(F.trunc("_e", "month") == F.col("month")).alias("leavers"))
    return g.withColumn("turnover_rate", rnd(ratio("leavers", (F.col("headcount_start") + F.col("headcount_end")) / 2), 6))


def utilization(entries: DataFrame, person: str, date: str, hours: str, capacity: float, week_start_dow: int = 2):
    """Hours vs capacity per person x configurable week (T4)."""
    from ..functions.columns import week_start
    g = entries.groupBy(person, week_start(F.col(date), week_start_dow).alias("week_start")).agg(
        F.sum(hours).alias("hours"))
    return g.withColumns({"capacity_hours": F.lit(float(capacity)),
                          "utilization": rnd(ratio("hours", F.lit(float(capacity))), 6)})


def coverage(shifts: DataFrame, dims: list[str], date: str, state: str, states: dict) -> DataFrame:
    """Shifts by state (filled / open / agency ...) per day x dims and the fill rate."""
    g = shifts.groupBy(F.to_date(F.col(date).cast("timestamp")).alias("date"), *dims).agg(
        F.count(F.lit(1)).alias("shifts"), *[F.count_if(F.col(state).isin(v)).alias(k) for k, v in states.items()])
    first = list(states)[0]
    return g.withColumn(f"{first}_rate", rnd(ratio(first, "shifts"), 6))


# Lead-time bands in days and their labels.
LEAD_EDGES = [7, 30, 90]
LEAD_LABELS = ["0-7 days", "8-30 days", "31-90 days", "91+ days"]


def booking_lead_time(reservations: DataFrame, booked: str, start: str, covers: str) -> DataFrame:
    """Bookings and covers per lead-time band (ordered), plus feedback-style sum and count."""
    from ..functions.columns import band
    lead = F.datediff(F.to_date(F.col(start).cast("timestamp")), F.to_date(F.col(booked).cast("timestamp")))
    lab, order = band(lead, LEAD_EDGES, LEAD_LABELS, null_label="unknown")
    return reservations.groupBy(lab.alias("lead_time_band"), order.alias("band_order")).agg(
        F.count(F.lit(1)).alias("bookings"), F.sum(covers).alias("covers"), F.sum(lead).alias("lead_days_sum"))


def growth_rates(facts: list[DataFrame], entity: list[str], month: str, measures: list[str]) -> DataFrame:
    """D101: monthly facts full-joined at one grain, then growth vs the previous row."""
    from .joins import merge_full
    from .windows import period_change
    m = merge_full(facts, entity + [month], fill=None)
    return period_change(m, entity, month, measures, digits=6)


def store_conversion(df: DataFrame, dims: list[str], kind: str, steps: list[str]) -> DataFrame:
    """D102: impressions -> page views -> downloads and conversion between steps."""
    from .support import distribution_funnel
    return distribution_funnel(df, dims, kind, steps)


def entity_inventory(df: DataFrame, key: str, created: str, is_open, as_of, stale_days: int = 365) -> DataFrame:
    """D103: current-state list with age in days and stale / open flags."""
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    age = F.datediff(a, F.to_date(F.col(created).cast("timestamp")))
    return df.withColumns({"age_days": age, "is_open": is_open, "is_stale": is_open & (age > stale_days)})


def entity_health(inv: DataFrame, group: list[str]) -> DataFrame:
    """D103: per project: entities, open, stale share and median age (exact)."""
    from ..functions.aggregates import quantile
    g = inv.groupBy(*group).agg(F.count(F.lit(1)).alias("entities"), F.count_if("is_open").alias("open_entities"),
                                F.count_if("is_stale").alias("stale_entities"),
                                rnd(quantile("age_days", 0.5, exact=True), 2).alias("median_age_days"))
    return g.withColumn("stale_share", rnd(ratio("stale_entities", "open_entities"), 6))


def publishing_cadence(posts: DataFrame, revisions: DataFrame, author: str, published: str, edited: str) -> DataFrame:
    """D104: published and edited per month x author, full outer so months with only one
    kind survive."""
    from .joins import merge_full
    m = lambda c: F.to_date(F.date_trunc("month", F.col(c).cast("timestamp")))
    p = posts.groupBy(author, m(published).alias("month")).agg(F.count(F.lit(1)).alias("published"))
    r = revisions.groupBy(author, m(edited).alias("month")).agg(F.count(F.lit(1)).alias("edited"))
    return merge_full([p, r], [author, "month"], fill=0)


def rollup_local_day(steps: DataFrame, keys: list[str], ts: str, value: str, zone: str, mode_col: str) -> DataFrame:
    """D105: sub-daily rows -> local days (P10): min / max / avg and the most frequent
    category (A7), plus the deviation of the day's mean from the previous 7 calendar
    days' mean (W12, current day excluded)."""
    from ..functions.columns import local_date
    from ..functions.aggregates import mode_of
    from .windows import trailing_agg
    g = steps.groupBy(*keys, local_date(F.col(ts), zone).alias("local_date")).agg(
        F.min(value).alias("min_value"), F.max(value).alias("max_value"), F.sum(value).alias("_sum"),
        F.count(F.lit(1)).alias("_n"), mode_of(mode_col).alias("mode_category"))
    g = g.withColumn("avg_value", rnd(F.col("_sum") / F.col("_n"), 4))
    g = trailing_agg(g, keys, "local_date", "_sum", 7, "sum", include_current=False, out="_ps")
    g = trailing_agg(g, keys, "local_date", "_n", 7, "sum", include_current=False, out="_pn")
    return g.withColumn("deviation_from_prior_7d", rnd(F.col("_sum") / F.col("_n") - ratio("_ps", "_pn"), 4)).drop(
        "_sum", "_n", "_ps", "_pn")


def reported_vs_rebuilt(reported: DataFrame, rebuilt: DataFrame, on, measure: str) -> DataFrame:
    """D106: the provider's own daily figure beside the same rebuilt from the log (full outer)."""
    from .joins import merge_full
    r = reported.withColumnRenamed(measure, f"reported_{measure}")
    b = rebuilt.withColumnRenamed(measure, f"rebuilt_{measure}")
    m = merge_full([r, b], on, fill=None)
    return m.withColumn(f"{measure}_difference",
                        rnd(F.coalesce(F.col(f"rebuilt_{measure}"), F.lit(0.0)) - F.coalesce(F.col(f"reported_{measure}"), F.lit(0.0)), 2))


def profile_activity(parts: list[DataFrame], on, share_part: list[str], share_col: str) -> DataFrame:
    """D107: several reports merged at one grain (full outer, zero-filled) with a share
    of one measure within ``share_part``."""
    from .joins import merge_full
    from .windows import share_of
    return share_of(merge_full(parts, on, fill=0), share_part, share_col, out=f"share_of_{share_col}", digits=6)


def cycle_times(issues: DataFrame, created: str, started: str, completed: str, due: str) -> DataFrame:
    """Completed issues with lead time (from creation) and cycle time (from the start) in days and whether they
    were completed after the due date."""
    days = lambda a, b: rnd(F.timestamp_diff("SECOND", F.col(a), F.col(b)) / 86400.0, 2)
    return issues.where(F.col(completed).isNotNull()).withColumns({
        "completed_date": _d(completed), "lead_time_days": days(created, completed), "cycle_time_days": days(started, completed),
        "completed_after_due_date": F.coalesce(_d(completed) > _d(due), F.lit(False))})


def responder_load(involvement: DataFrame, incidents: DataFrame, incident: str, user: str, role: str, created: str,
                   roles: dict, high=None) -> DataFrame:
    """Per day of the incident x responder: distinct incidents by role (``roles = {name: role value}``) and those
    assigned with high urgency."""
    j = involvement.join(incidents, incident)
    aggs = [F.count_distinct(F.when(F.col(role) == v, F.col(incident))).alias(f"incidents_{n}") for n, v in roles.items()]
    if high is not None:
        first = next(iter(roles.values()))
        aggs.append(F.count_distinct(F.when((F.col(role) == first) & high, F.col(incident))).alias("high_urgency_incidents"))
    return j.groupBy(F.to_date(F.col(created).cast("timestamp")).alias("date"), user).agg(*aggs)
