"""Support, messaging waits and surveys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.aggregates import quantile
from ..functions.columns import ratio, rnd


def _l(x):
    return [x] if isinstance(x, str) else list(x)


def reply_waits(messages: DataFrame, thread: str, ts: str, direction: str, received="received",
                sent="sent", order=None, bucket=None) -> DataFrame:
    """A wait opens at a received message whose previous message in the thread is
    absent or sent; the reply is the earliest sent message strictly after it in row order.

    Previous message and next reply are computed per (thread, ``bucket``) and fixed up
    across buckets (two-level, see ``seq_neighbors`` / ``seq_next_when``); ``bucket``
    defaults to the hour of ``ts`` (use a coarse bucket of the ordinal for turn numbers).
    """
    from .windows import seq_prev_and_next_when
    o = [ts] + (_l(order) if order else [])
    bk = bucket if bucket is not None else F.date_trunc("hour", F.col(ts).cast("timestamp"))
    m = seq_prev_and_next_when(messages, thread, o, [direction], F.col(direction) == sent, ts, "_reply", bk,
                               prev_prefix="_prev_")
    prev_dir = F.col(f"_prev_{direction}")
    opens = (F.col(direction) == received) & (prev_dir.isNull() | (prev_dir == sent))
    return m.where(opens).select(thread, F.col(ts).alias("waiting_since"), F.col("_reply").alias("replied_at"),
                                 F.col("_reply").isNotNull().alias("is_answered"))


def ticket_lifecycle(tickets: DataFrame, messages: DataFrame, key: str, created: str, ts: str,
                     is_reply, resolved: str | None = None) -> DataFrame:
    """First human reply, reply counts and resolution per ticket (message facts
    rolled up per ticket before the join)."""
    m = messages.groupBy(key).agg(F.min(F.when(is_reply, F.col(ts))).alias("first_reply_at"),
                                  F.count_if(is_reply).alias("reply_count"), F.count(F.lit(1)).alias("message_count"),
                                  F.max(ts).alias("last_message_at"))
    j = tickets.join(m, key, "left")
    return j.withColumns({"reply_count": F.coalesce("reply_count", F.lit(0)),
                          "is_answered": F.col("first_reply_at").isNotNull()})


def volume_backlog(tickets: DataFrame, created: str, closed: str, dims: list[str], as_of) -> DataFrame:
    """Created and closed per day x dims (each on its own day) on a grid from the
    dims' first created day to the latest of as_of / created / closed; backlog =
    running sum of created - closed."""
    from .timegrid import densify, events_from_timestamps
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    daily = events_from_timestamps(tickets, {created: "created", closed: "closed"}, dims)
    wd = Window.partitionBy(*dims)
    g = densify(daily, dims, "date", ["created", "closed"], fill=0,
                start=F.min(F.when(F.col("created") > 0, F.col("date"))).over(wd),
                end=F.greatest(F.max("date").over(wd), a))
    w = Window.partitionBy(*dims).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return g.withColumn("open_backlog", F.sum(F.col("created") - F.col("closed")).over(w))


def response_stats(df: DataFrame, dims: list[str], period: str, measure: str, sla: float,
                   exact: bool = False) -> DataFrame:
    """Mean, median, p90 and SLA attainment of a response measure per period x dims."""
    rows = df.where(F.col(measure).isNotNull())
    if exact:
        # equal values are counted first: percentiles of more than a few groups would sort every row
        n, v = F.col("_n"), F.col(measure).cast("double")
        g = rows.groupBy(period, *dims, measure).agg(F.count(F.lit(1)).alias("_n")).groupBy(period, *dims).agg(
            F.sum(n).alias("responses"), rnd(F.sum(v * n) / F.sum(n), 4).alias("mean_value"),
            rnd(F.percentile(v, F.lit(0.5), n), 4).alias("median_value"), rnd(F.percentile(v, F.lit(0.9), n), 4).alias("p90_value"),
            F.sum(F.when(F.col(measure) <= sla, n).otherwise(0)).alias("within_sla"))
    else:
        g = rows.groupBy(period, *dims).agg(
            F.count(F.lit(1)).alias("responses"), rnd(F.avg(measure), 4).alias("mean_value"),
            rnd(quantile(measure, 0.5), 4).alias("median_value"), rnd(quantile(measure, 0.9), 4).alias("p90_value"),
            F.count_if(F.col(measure) <= sla).alias("within_sla"))
    return g.withColumn("sla_attainment", rnd(ratio("within_sla", "responses"), 6))


def csat(ratings: DataFrame, dims: list[str], satisfied) -> DataFrame:
    """Satisfied share per dims."""
    g = ratings.groupBy(*dims).agg(F.count(F.lit(1)).alias("ratings"), F.count_if(satisfied).alias("satisfied"))
    return g.withColumn("csat", rnd(ratio("satisfied", "ratings"), 6))


def nps(df: DataFrame, score: str, dims: list[str]) -> DataFrame:
    """valid = integer 0..10; >= 9 promoter, 7-8 passive, <= 6 detractor;
    NPS = 100 * (promoters - detractors) / valid; invalid answers counted apart."""
    s = F.col(score)
    valid = s.isNotNull() & (s >= 0) & (s <= 10) & (s == F.floor(s))
    g = df.groupBy(*dims).agg(
        F.count_if(valid & (s >= 9)).alias("promoters"), F.count_if(valid & (s >= 7) & (s < 9)).alias("passives"),
        F.count_if(valid & (s <= 6)).alias("detractors"), F.count_if(valid).alias("valid_responses"),
        F.count_if(~valid | s.isNull()).alias("invalid_responses"))
    return g.withColumn("nps", rnd(ratio(F.col("promoters") - F.col("detractors"), "valid_responses", scale=100), 4))


def scale_scores(answers: DataFrame, score: str, dims: list[str], scale_max: int) -> DataFrame:
    """Average and top-two-box share (score >= max - 1) per dims; scores above the
    scale's maximum are counted apart."""
    on_scale = F.when(F.col(score) <= scale_max, F.col(score))
    g = answers.where(F.col(score).isNotNull()).groupBy(*dims).agg(
        F.count(on_scale).alias("answers"), rnd(F.avg(on_scale), 4).alias("avg_score"),
        F.count_if(on_scale >= scale_max - 1).alias("top_two_box"),
        F.count_if(F.col(score) > scale_max).alias("off_scale"))
    return g.withColumn("top_two_box_share", rnd(ratio("top_two_box", "answers"), 6))


def topic_share(tags: DataFrame, record: str, topic: str, dims: list[str]) -> DataFrame:
    """Share of commenting records per topic (distinct records)."""
    tot = tags.groupBy(*dims).agg(F.count_distinct(record).alias("commenting_records"))
    g = tags.groupBy(*dims, topic).agg(F.count_distinct(record).alias("records"))
    from .joins import join_ns
    j = join_ns(g, tot, dims, "left") if dims else g.crossJoin(F.broadcast(tot))  # without dims: one row
    return j.withColumn("topic_share", rnd(ratio("records", "commenting_records"), 6))


def agent_performance(facts: dict, agent: str, period: str) -> DataFrame:
    """Several facts per agent x period on the union of their keys (each rolled up first)."""
    from .aggs import rollup_facts
    return rollup_facts(None, facts, [agent, period], fill=0)


def answer_detail(responses: DataFrame, key: str, answers: str, labels: DataFrame | None = None,
                  label_key: str | None = None, path: str | None = None, schema: str = "string") -> DataFrame:
    """Long answers: array answers exploded with their position, choice labels resolved. ``answers`` is an
    array column, or JSON text whose list stands at ``path`` (entries read as ``schema``)."""
    if path is not None:
        from .arrays import explode_json
        ex = explode_json(responses, answers, schema, path, out="answer").withColumnRenamed("pos", "position").drop(answers)
    else:
        ex = responses.select(key, *[c for c in responses.columns if c not in (key, answers)],
                              F.posexplode(F.col(answers)).alias("position", "answer"))
    if labels is not None:
        ex = ex.join(labels, label_key, "left")
    return ex


def response_volume(responses: DataFrame, form: str, ts: str, completed, duration: str, as_of,
                    exact: bool = True) -> DataFrame:
    """Responses, completion rate and median duration per form x day on a grid from
    the form's first day to ``as_of``."""
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    d = responses.groupBy(form, F.to_date(F.col(ts).cast("timestamp")).alias("date")).agg(
        F.count(F.lit(1)).alias("responses"), F.count_if(completed).alias("completed"),
        rnd(quantile(duration, 0.5, exact), 4).alias("median_duration"))
    span = d.groupBy(form).agg(F.min("date").alias("_s"))
    grid = span.select(form, F.explode(F.sequence("_s", F.greatest(a, F.col("_s")))).alias("date"))
    g = grid.join(d, [form, "date"], "left").fillna({"responses": 0, "completed": 0})
    return g.withColumn("completion_rate", rnd(ratio("completed", "responses"), 6))


def attribution_by_answer(answers: DataFrame, answer: str, order_id: str, value: str, dims: list[str]) -> DataFrame:
    """Distinct orders and their revenue per answer (orders de-duplicated first so a
    response answered twice does not double revenue)."""
    u = answers.select(*dims, answer, order_id, value).dropDuplicates([*dims, answer, order_id])
    return u.groupBy(*dims, answer).agg(F.count_distinct(order_id).alias("orders"), rnd(F.sum(value), 2).alias("revenue"))


def distribution_funnel(df: DataFrame, dims: list[str], stage_col: str, stages: list[str]) -> DataFrame:
    """Counts per funnel stage (wide) and each stage's rate against the previous and the first."""
    g = df.groupBy(*dims).agg(*[F.count_if(F.col(stage_col) == s).alias(s) for s in stages])
    cols = {}
    for prev, cur in zip(stages, stages[1:]):
        cols[f"{cur}_rate"] = rnd(ratio(cur, prev), 6)
        cols[f"{cur}_of_{stages[0]}"] = rnd(ratio(cur, stages[0]), 6)
    return g.withColumns(cols)


def reviews_running(reviews: DataFrame, entity: list[str], ts: str, rating: str, replied, as_of,
                    negative_max: int = 2) -> DataFrame:
    """New / replied / negative reviews per month on a grid to ``as_of``, plus the
    running review count and running average rating."""
    from .timegrid import densify
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    m = F.to_date(F.date_trunc("month", F.col(ts).cast("timestamp")))
    g = reviews.groupBy(*entity, m.alias("month")).agg(
        F.count(F.lit(1)).alias("new_reviews"), F.count_if(replied).alias("replied_reviews"),
        F.count_if(F.col(rating) <= negative_max).alias("negative_reviews"), F.sum(rating).alias("_rs"))
    g = densify(g, entity, "month", ["new_reviews", "replied_reviews", "negative_reviews", "_rs"],
                end=F.trunc(a, "month"), step="month")
    w = Window.partitionBy(*entity).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return g.withColumns({"running_reviews": F.sum("new_reviews").over(w),
                          "running_avg_rating": rnd(ratio(F.sum("_rs").over(w), F.sum("new_reviews").over(w)), 4)}
                         ).drop("_rs")


def ticket_times(tickets: DataFrame, messages: DataFrame, key: str, created: str, ts: str, is_reply,
                 resolved: str, rating: str | None = None, tiebreak: list[str] | None = None) -> DataFrame:
    """D75 with durations: minutes from creation to the first reply and to the resolution (never
    negative), and the latest rating given in a message. Ratings of one moment are ordered by
    ``tiebreak``, then by the rating itself (the largest counts), so the result never depends on row order."""
    out = ticket_lifecycle(tickets, messages, key, created, ts, is_reply, resolved)
    minutes = lambda c: F.when(F.col(c).isNotNull(),
                               F.greatest(F.timestamp_diff("MINUTE", F.col(created), F.col(c)), F.lit(0)))
    out = out.withColumns({"first_response_minutes": minutes("first_reply_at"), "resolution_minutes": minutes(resolved)})
    if rating:
        last = messages.where(F.col(rating).isNotNull()).groupBy(key).agg(F.max_by(rating, F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate([ts, *(tiebreak or []), rating])])).alias("latest_rating"))
        out = out.join(last, key, "left")
    return out


def one_touch(tickets: DataFrame, dims: list[str], replies: str, resolved: str, period: str = "month") -> DataFrame:
    """Per period of resolution x dims: solved tickets and the share solved with at most one reply."""
    when = F.to_date(F.date_trunc(period, F.col(resolved).cast("timestamp"))).alias(period)
    g = tickets.where(F.col(resolved).isNotNull()).groupBy(when, *dims).agg(
        F.count(F.lit(1)).alias("solved"), F.count_if(F.coalesce(replies, F.lit(0)) <= 1).alias("one_touch"))
    return g.withColumn("one_touch_rate", rnd(ratio("one_touch", "solved"), 6))
