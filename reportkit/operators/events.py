"""Events, funnels, audiences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import ratio, rnd


def sessionize(events: DataFrame, user: str, ts: str, event: str | None = None,
               tiebreak: str | None = None, gap_minutes: int = 30,
               split_at_midnight: bool = True) -> DataFrame:
    """Sessions from an event log.

    A user's event opens a new session when the whole seconds since the user's
    previous event exceed ``gap_minutes * 60`` (exactly the gap continues), or
    (``split_at_midnight``) when the UTC date changes. NULL users are dropped.

    Skew-safe plan: time is cut into buckets one gap wide. Inside a bucket no
    gap can exceed the limit, so only a bucket's first event can open a
    session, and its predecessor is the last event of the previous non-empty
    bucket. Events are therefore hash-aggregated per (user, day, bucket) --
    combining map-side, so a user holding a third of all rows is never sorted
    in one task -- and the range windows that find each bucket's predecessor and
    number the sessions run over the user-day's (bucket, event name) rows: at most
    24*60/gap buckets times the distinct event names, whatever the user's volume.
    The events are read once.
    """
    gap_s = gap_minutes * 60
    t = F.col(ts).cast("timestamp")
    e = events.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
    tb = F.col(tiebreak) if tiebreak else F.lit(None).cast("string")
    ev = F.col(event) if event else F.lit(None).cast("string")
    if split_at_midnight:
        part = [F.col(user).alias("_u"), F.to_date(t).alias("_d")]
        bk = F.floor(F.timestamp_diff("MICROSECOND", F.date_trunc("day", t), t) / F.lit(gap_s * 1_000_000))
    else:
        part = [F.col(user).alias("_u"), F.lit(None).cast("date").alias("_d")]
        bk = F.floor(F.unix_micros(t) / F.lit(gap_s * 1_000_000))
    rows = e.select(*part, bk.cast("long").alias("_bk"), t.alias("_t"), tb.alias("_tb"), ev.alias("_ev"))
    # one pass over the events: aggregate per (user, day, bucket, event name)
    per_name = (rows.groupBy("_u", "_d", "_bk", "_ev")
                .agg(F.min(F.struct("_t", "_tb", "_ev")).alias("_first"), F.max("_t").alias("_last"),
                     F.count(F.lit(1)).alias("_n")))
    # bucket-level figures are range windows over the (bucket, name) rows of the user-day,
    # so per_name is consumed once: the bucket's first event, the last event of all
    # earlier buckets, the session start flag and the running session number
    w_bk = Window.partitionBy("_u", "_d").orderBy("_bk")
    same_bk = w_bk.rangeBetween(0, 0)
    rows2 = per_name.withColumns({"_bfirst": F.min("_first").over(same_bk),
                                  "_prev_last": F.max("_last").over(w_bk.rangeBetween(Window.unboundedPreceding, -1))})
    start_flag = F.col("_prev_last").isNull() | \
        (F.timestamp_diff("SECOND", F.col("_prev_last"), F.col("_bfirst._t")) > gap_s)
    rep = F.col("_ev").eqNullSafe(F.col("_bfirst._ev"))  # one row per bucket carries its start
    rows2 = rows2.withColumn("_start", F.when(rep & start_flag, 1).otherwise(0))
    rows2 = rows2.withColumn("_seq", F.sum("_start").over(w_bk.rangeBetween(Window.unboundedPreceding, 0)))
    sess = (rows2.groupBy("_u", "_d", "_seq")
            .agg(F.min("_first").alias("_first"), F.max("_last").alias("session_ended_at"),
                 F.sum("_n").alias("events"), F.count_distinct("_ev").alias("distinct_event_names")))
    day = F.col("_d") if split_at_midnight else F.to_date(F.col("_first._t"))
    return sess.select(
        F.concat_ws(":", F.col("_u").cast("string"), day.cast("string"), F.col("_seq").cast("string")).alias("session_id"),
        F.col("_u").alias(user),
        day.alias("session_date"),
        F.col("_seq").cast("long").alias("session_number_of_day"),
        F.col("_first._t").alias("session_started_at"),
        "session_ended_at",
        F.timestamp_diff("SECOND", F.col("_first._t"), F.col("session_ended_at")).alias("duration_seconds"),
        "events",
        F.coalesce("distinct_event_names", F.lit(0)).alias("distinct_event_names"),
        F.col("_first._ev").alias("first_event_name"))


def active_users(events: DataFrame, user: str, ts: str, wau_days: int = 7, mau_days: int = 28) -> DataFrame:
    """DAU, trailing WAU / MAU, new / returning users, stickiness, full-window flag.

    Rows only for days with activity. Sweep line instead of a days x user-days join,
    in one pass over the distinct user-days: a user-day opens a coverage island when
    the user's previous active day is at least N days earlier (+1 on that day) and
    closes one when the next is at least N days later (-1 on day + N); every user-day
    emits its own row plus those markers (one explode), one aggregate per calendar
    day sums them, and running sums over the calendar give the distinct counts. The
    per-user window runs over the user's active days (bounded by the calendar); the
    only unpartitioned window runs over calendar days.
    """
    ud = (events.where(F.col(user).isNotNull())
          .select(F.col(user).alias("_u"), F.to_date(F.col(ts).cast("timestamp")).alias("date")).distinct())
    wu = Window.partitionBy("_u").orderBy("date")
    ud = ud.withColumns({"_prev": F.lag("date").over(wu), "_next": F.lead("date").over(wu),
                         "_first_day": F.min("date").over(Window.partitionBy("_u"))})

    def opens(n):
        return F.when(F.col("_prev").isNull() | (F.datediff("date", "_prev") >= n), 1).otherwise(0)

    def closes(n):
        return F.col("_next").isNull() | (F.datediff("_next", "date") >= n)

    def item(d, active, new, dw, dm):
        return F.struct(d.alias("d"), F.lit(active).alias("active") if isinstance(active, int) else active.alias("active"),
                        new.alias("new"), dw.alias("dw"), dm.alias("dm"))
    z, f = F.lit(0), F.lit(False)
    items = F.array(
        item(F.col("date"), 1, F.col("date") == F.col("_first_day"), opens(wau_days), opens(mau_days)),
        F.when(closes(wau_days), item(F.date_add("date", wau_days), 0, f, F.lit(-1), z)),
        F.when(closes(mau_days), item(F.date_add("date", mau_days), 0, f, z, F.lit(-1))))
    ex = ud.select(F.explode(items).alias("x")).where(F.col("x").isNotNull())
    per_day = ex.groupBy(F.col("x.d").alias("date")).agg(
        F.sum("x.active").cast("long").alias("dau"), F.count_if("x.new").alias("new_users"),
        F.sum("x.dw").alias("_dw"), F.sum("x.dm").alias("_dm"))
    wc = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)  # calendar-sized
    per_day = per_day.withColumns({"wau": F.sum("_dw").over(wc).cast("long"), "mau": F.sum("_dm").over(wc).cast("long"),
                                   "_fd": F.min(F.when(F.col("dau") > 0, F.col("date"))).over(wc)})
    return per_day.where(F.col("dau") > 0).select(
        "date", "dau", "wau", "mau", "new_users",
        (F.col("dau") - F.col("new_users")).alias("returning_users"),
        ratio("dau", "mau").alias("dau_mau_stickiness"),
        (F.col("date") >= F.date_add("_fd", mau_days - 1)).alias("is_full_window"))


def monthly_active(logins: DataFrame, users: DataFrame | None, user: str, ts: str,
                   created: str | None, as_of) -> DataFrame:
    """Distinct actives per month; new / returning / unknown; completeness flag."""
    month = F.to_date(F.date_trunc("month", F.col(ts).cast("timestamp")))
    active = logins.where(F.col(user).isNotNull()).select(month.alias("month_start"), F.col(user).alias("_u")).distinct()
    cov = logins.agg(F.min(F.to_date(F.col(ts).cast("timestamp"))).alias("_first_log"))
    a = F.lit(as_of).cast("date") if not hasattr(as_of, "_jc") else as_of
    if users is not None:
        u = users.select(F.col(user).alias("_u"), F.to_date(F.date_trunc("month", F.col(created).cast("timestamp"))).alias("_cm"))
        u = u.groupBy("_u").agg(F.min("_cm").alias("_cm"))
        j = active.join(u, "_u", "left")
    else:
        firsts = active.groupBy("_u").agg(F.min("month_start").alias("_cm"))
        j = active.join(firsts, "_u", "left")
    g = j.groupBy("month_start").agg(
        F.count(F.lit(1)).alias("monthly_active_users"),
        F.count_if(F.col("_cm") == F.col("month_start")).alias("new_active_users"),
        F.count_if(F.col("_cm") < F.col("month_start")).alias("returning_active_users"),
        F.count_if(F.col("_cm").isNull()).alias("active_users_not_in_users_table"))
    return g.crossJoin(F.broadcast(cov)).select(
        "month_start", "monthly_active_users", "new_active_users", "returning_active_users",
        "active_users_not_in_users_table",
        ((F.col("_first_log") <= F.col("month_start")) & (F.col("month_start") < F.trunc(a, "month"))).alias("is_complete_month"))


def funnel_metrics(step_counts: DataFrame, funnel, date: str, step_no: str, users: str) -> DataFrame:
    """Users entered (step 1) and drop-off / conversion against the previous step."""
    part = ([funnel] if isinstance(funnel, str) else list(funnel)) + [date]
    w = Window.partitionBy(*part).orderBy(step_no)
    wf = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    prev = F.lag(users).over(w)
    first = F.first(users).over(wf)
    return step_counts.withColumns({
        "users_entered": first,
        "drop_off": prev - F.col(users),
        "step_conversion": rnd(ratio(F.col(users), prev), 6),
        "overall_conversion": rnd(ratio(F.col(users), first), 6)})


def step_counts_from_events(events: DataFrame, user: str, ts: str, event: str, steps: list[str],
                            funnel_id: str = "funnel") -> DataFrame:
    """Daily distinct users per funnel step (the step-count input of D04)."""
    idx = F.array_position(F.array(*[F.lit(s) for s in steps]), F.col(event))
    return (events.where(F.col(event).isin(steps) & F.col(user).isNotNull())
            .groupBy(F.lit(funnel_id).alias("funnel_id"), F.to_date(F.col(ts).cast("timestamp")).alias("date"),
                     idx.cast("int").alias("step_number"), F.col(event).alias("step_event"))
            .agg(F.count_distinct(user).alias("users")))


def event_counts(events: DataFrame, ts: str, event: str, user: str) -> DataFrame:
    """Events and unique users per day x event."""
    return (events.groupBy(F.to_date(F.col(ts).cast("timestamp")).alias("date"), F.col(event).alias("event_name"))
            .agg(F.count(F.lit(1)).alias("events"), F.count_distinct(user).alias("unique_users"))
            .withColumn("events_per_user", rnd(ratio("events", "unique_users"), 6)))


def cohort_funnel(leads: DataFrame, created: str, converted: str, won: str, dims: list[str],
                  end=None) -> DataFrame:
    """Created cohort followed to conversion / won, beside activity on its own day,
    on a dims x day spine from each dims' first day."""
    from .timegrid import densify
    d = lambda c: F.to_date(F.col(c).cast("timestamp"))
    cohort = leads.groupBy(*dims, d(created).alias("date")).agg(
        F.count(F.lit(1)).alias("created"),
        F.count_if(F.col(converted).isNotNull()).alias("cohort_converted"),
        F.count_if(F.col(won).isNotNull()).alias("cohort_won"))
    from .timegrid import events_from_timestamps
    act = events_from_timestamps(leads, {converted: "converted_on_day", won: "won_on_day"}, dims)
    from .joins import join_ns
    facts = join_ns(cohort, act, dims + ["date"], "full")
    out = densify(facts, dims, "date", ["created", "cohort_converted", "cohort_won", "converted_on_day", "won_on_day"],
                  end=end)
    return out.withColumns({"cohort_conversion_rate": rnd(ratio("cohort_converted", "created"), 6)})


def audience_growth(df: DataFrame, entity, date: str, level: str | None = None, gain: str | None = None,
                    total: str | None = None) -> DataFrame:
    """Daily net change, gap-guarded on a level series, or back-cast from today's
    total using daily gains (level = total - sum of later gains)."""
    from .windows import back_cast, daily_change
    if level:
        return daily_change(df, entity, date, level, out="net_change")
    return back_cast(df, entity, date, gain, total, out="followers_total")


def weighted_shares(shares: DataFrame, volumes: DataFrame, on, part, share: str, volume: str) -> DataFrame:
    """Apply per-slice shares to the slice's volume (NULL-safe keys), then share of total."""
    from .joins import join_ns
    from .windows import share_of
    j = join_ns(shares, volumes, on)
    j = j.withColumn("estimated_volume", F.col(share) * F.col(volume))
    return share_of(j, part, "estimated_volume", out="share_of_total", digits=6)


def search_performance(df: DataFrame, grain: list[str], clicks: str, impressions: str, position: str,
                       share_part: list[str] | None = None) -> DataFrame:
    """Clicks, impressions, CTR, impression-weighted position, query share per page."""
    from .windows import share_of
    g = df.groupBy(*grain).agg(
        F.sum(clicks).alias("clicks"), F.sum(impressions).alias("impressions"),
        F.sum(F.col(position) * F.col(impressions)).alias("position_weighted_sum"))
    g = g.withColumns({"ctr": rnd(ratio("clicks", "impressions"), 6),
                       "avg_position": rnd(ratio("position_weighted_sum", "impressions"), 6)})
    return share_of(g, share_part, "clicks", out="click_share", digits=6) if share_part else g


def content_performance(metrics: DataFrame, key, metric: str, value: str, mapping: dict,
                        rates: dict | None = None) -> DataFrame:
    """Long metric rows -> one row per post with lifetime metrics and rates."""
    from .aggs import pivot_kv, with_ratios
    out = pivot_kv(metrics, key, metric, value, mapping, fn="max")
    return with_ratios(out, rates, digits=6) if rates else out
