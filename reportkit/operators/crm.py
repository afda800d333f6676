"""CRM and sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio, rnd


def _l(x):
    return [x] if isinstance(x, str) else list(x)


def stage_history(changes: DataFrame, key, value: str, ts: str, as_of, stage_order: dict | None = None,
                  tiebreak: str | None = None, pipeline: str | None = None, bucket=None) -> DataFrame:
    """Change log -> stage stays: entered, exited (= next entry; an open stay ends
    at ``as_of``), next stage, hours in stage (minutes / 60), current flag, moved backwards
    (the stay that is left for an earlier stage by ``stage_order``, only if both are in one
    pipeline). NULL values dropped; repeats compressed (W8). One current stay per key,
    also when its pipeline changes.

    Neighbours are found with the two-level ``seq_neighbors`` (per key x hour, then
    across the key's hours), so a key with a huge change log is never sorted in one
    task. ``bucket`` overrides the day bucketing (must grow with ``ts``).
    """
    from .windows import change_points, seq_neighbors
    keys = _l(key)
    order = [ts] + ([tiebreak] if tiebreak else [])
    bk = bucket if bucket is not None else F.date_trunc("hour", F.col(ts).cast("timestamp"))
    c = change_points(changes, keys, order, value, bucket=bk)
    a = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    carry = [ts, value] + ([pipeline] if pipeline else [])
    if stage_order:
        rank = F.element_at(F.create_map(*[x for k, v in stage_order.items() for x in (F.lit(k), F.lit(v))]), F.col(value))
        c = c.withColumn("_rank", rank)
        carry.append("_rank")
    c = seq_neighbors(c, keys, order, carry, bk, prev_prefix=None, next_prefix="_n2_")
    c = c.withColumns({"entered_at": F.col(ts), "exited_at": F.col(f"_n2_{ts}"), "next_stage": F.col(f"_n2_{value}")})
    c = c.withColumns({
        "is_current": F.col("exited_at").isNull(),
        "hours_in_stage": rnd(F.timestamp_diff("MINUTE", F.col("entered_at"),
                                                F.coalesce(F.col("exited_at"), a)) / F.lit(60.0), 4)})
    if stage_order:
        back = F.col("_n2__rank") < F.col("_rank")
        if pipeline:
            back = back & (F.col(f"_n2_{pipeline}") == F.col(pipeline))
        c = c.withColumn("moved_backwards", F.coalesce(back, F.lit(False)))
    return c.drop(*[x for x in c.columns if x.startswith("_n2_") or x == "_rank"])


def flow_by_period(df: DataFrame, created: str, won: str, lost: str, dims: list[str], period: str = "month",
                   as_of=None) -> DataFrame:
    """Created / won / lost per period x dims on a full grid (from each dims'
    first period to as_of), win rate = won / (won + lost)."""
    from .timegrid import densify, events_from_timestamps
    trunc = (lambda c: F.to_date(F.date_trunc(period, c.cast("timestamp"))))
    daily = events_from_timestamps(df, {created: "created", won: "won", lost: "lost"}, dims,
                                   date_fn=trunc, out_date=period)
    end = F.trunc(F.lit(as_of).cast("date"), "month") if isinstance(as_of, str) else None
    g = densify(daily, dims, period, ["created", "won", "lost"], end=end, step="month" if period == "month" else "day")
    return g.withColumn("win_rate", rnd(ratio("won", F.col("won") + F.col("lost")), 6))


def count_by(df: DataFrame, dims: list[str], lookup: DataFrame | None = None, on=None, measure: str | None = None) -> DataFrame:
    """Count (and optional sum) per dims, joined to names, sorted by count (O1)."""
    aggs = [F.count(F.lit(1)).alias("record_count")]
    if measure:
        aggs.append(rnd(F.sum(measure), 2).alias(f"total_{measure}"))
    g = df.groupBy(*dims).agg(*aggs)
    if lookup is not None:
        g = g.join(lookup, _l(on), "left")
    return g.orderBy(F.col("record_count").desc(), *dims)


def snapshot_by_stage(deals: DataFrame, stage: str, value: str, created: str, is_open, as_of) -> DataFrame:
    """Open deals per stage with value and average age (days) as of ``as_of``."""
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    age = F.datediff(a, F.to_date(F.col(created).cast("timestamp")))
    return (deals.where(is_open).groupBy(stage)
            .agg(F.count(F.lit(1)).alias("open_deals"), rnd(F.sum(value), 2).alias("open_value"),
                 rnd(F.avg(age), 4).alias("avg_age_days"), F.max(age).alias("max_age_days")))


def deal_pipeline(deals: DataFrame, status: str, won_values: list[str], lost_values: list[str],
                  amount: str, probability=None) -> DataFrame:
    """Deals classified won / lost / open with a weighted amount."""
    s = F.col(status)
    outcome = F.when(s.isin(won_values), "won").when(s.isin(lost_values), "lost").otherwise("open")
    p = probability if probability is not None else F.when(outcome == "won", 1.0).when(outcome == "lost", 0.0).otherwise(0.5)
    return deals.withColumns({"outcome": outcome, "weighted_amount": rnd(F.col(amount) * p, 2)})


def rep_activity(activities: dict, rep: str, ts: str, end=None) -> DataFrame:
    """Activities of several kinds per rep x day on a grid from the rep's first
    active day to ``end`` (default: the latest activity day)."""
    from functools import reduce
    from .timegrid import densify
    parts = [df.select(F.col(rep).alias(rep), F.to_date(F.col(ts).cast("timestamp")).alias("date"),
                       F.lit(kind).alias("_kind")) for kind, df in activities.items()]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    g = u.groupBy(rep, "date").agg(*[F.count_if(F.col("_kind") == k).alias(k) for k in activities])
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    g = densify(g, rep, "date", list(activities), end=e)
    total = None
    for k in activities:
        total = F.col(k) if total is None else total + F.col(k)
    return g.withColumn("total_activities", total)


def rep_activity_by_kind(df: DataFrame, rep: str, ts: str, kind: str, kinds: list[str], end=None) -> DataFrame:
    """D68 when all activity kinds live in one table: one scan, counted per kind with
    conditional aggregates, then the same rep x day grid as ``rep_activity``."""
    from .timegrid import densify
    g = (df.where(F.col(kind).isin(kinds))
         .groupBy(rep, F.to_date(F.col(ts).cast("timestamp")).alias("date"))
         .agg(*[F.count_if(F.col(kind) == k).alias(k) for k in kinds]))
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    g = densify(g, rep, "date", list(kinds), end=e)
    total = None
    for k in kinds:
        total = F.col(k) if total is None else total + F.col(k)
    return g.withColumn("total_activities", total)


def account_360(base: DataFrame, key: str, facts: dict) -> DataFrame:
    """Account row + every related fact rolled up to the account first."""
    from .aggs import rollup_facts
    return rollup_facts(base, facts, key, fill=None)


def bookings_by_source(bookings: DataFrame, id_col: str, next_col: str, is_new, booked_at: str,
                       source: str, outcome, final_ts: str) -> DataFrame:
    """Each new booking followed through its reschedule chain (R2) to the
    final record; per booking month x source x final outcome: bookings, reschedules,
    lead time (hours, from the original booking to the final record)."""
    from .timegrid import follow_chain
    ch = follow_chain(bookings.select(id_col, next_col), id_col, next_col)
    start = bookings.where(is_new).select(F.col(id_col).alias("id"), F.col(booked_at).alias("_booked"),
                                          F.coalesce(F.col(source).cast("string"), F.lit("(not set)")).alias("source"))
    fin = bookings.select(F.col(id_col).alias("final_id"), outcome.alias("final_outcome"), F.col(final_ts).alias("_fts"))
    j = start.join(ch, "id").join(fin, "final_id")
    return (j.groupBy(F.to_date(F.date_trunc("month", F.col("_booked").cast("timestamp"))).alias("booking_month"),
                      "source", "final_outcome")
            .agg(F.count(F.lit(1)).alias("bookings"), F.sum("hops").alias("reschedules"),
                 rnd(F.avg(F.timestamp_diff("MINUTE", F.col("_booked"), F.col("_fts")) / 60.0), 4).alias("avg_lead_time_hours")))


def meetings_daily(events: DataFrame, dims: list[str], booked: str, held: str) -> DataFrame:
    """Two date bases per dims x day: meetings booked on the day and held on the day."""
    from .timegrid import events_from_timestamps
    return events_from_timestamps(events, {booked: "meetings_booked", held: "meetings_held"}, dims)


def call_analytics(turns: DataFrame, call: str, speaker: str, text: str, speakers: list[str]) -> DataFrame:
    """Per call: turns, characters, talk share per speaker, questions asked,
    longest turn (stats pivoted from per-speaker rows)."""
    n = F.length(F.col(text))
    g = turns.groupBy(call).agg(
        F.count(F.lit(1)).alias("turns"), F.sum(n).alias("total_chars"),
        *[F.sum(F.when(F.col(speaker) == s, n).otherwise(0)).alias(f"{s}_chars") for s in speakers],
        F.count_if(F.col(text).contains("?")).alias("questions"), F.max(n).alias("longest_turn_chars"))
    return g.withColumns({f"{s}_talk_share": rnd(ratio(f"{s}_chars", "total_chars"), 6) for s in speakers})


def outcomes_by_cohort(deals: DataFrame, created: str, dims: list[str], status: str, value: str, changed: str,
                       won: str = "won", lost: str = "lost", open_: str = "open") -> DataFrame:
    """Deals by month of creation x dims with their outcome so far: counts and value by status, win rate among
    decided deals, mean days to win."""
    s = F.col(status)
    days = F.timestamp_diff("HOUR", F.col(created), F.col(changed)) / 24.0
    g = deals.where(F.col(created).isNotNull()).groupBy(
        F.to_date(F.date_trunc("month", F.col(created).cast("timestamp"))).alias("created_month"), *dims).agg(
        F.count(F.lit(1)).alias("deals"), *[F.count_if(s == k).alias(f"{n}_deals") for n, k in (("open", open_), ("won", won), ("lost", lost))],
        rnd(F.sum(value), 2).alias("total_value"), rnd(F.sum(F.when(s == won, F.col(value)).otherwise(0.0)), 2).alias("won_value"),
        rnd(F.sum(F.when(s == open_, F.col(value)).otherwise(0.0)), 2).alias("open_value"),
        rnd(F.avg(F.when(s == won, days)), 4).alias("avg_days_to_win"))
    return g.withColumn("win_rate", rnd(ratio("won_deals", F.col("won_deals") + F.col("lost_deals")), 6))
