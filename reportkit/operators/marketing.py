"""Advertising and messaging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio, rnd
from .joins import join_ns

# Delivery rates recomputed from summed parts -> (numerator, denominator, scale).
AD_RATES = {"ctr": ("clicks", "impressions", 1), "cpc": ("spend", "clicks", 1),
            "cpm": ("spend", "impressions", 1000), "cpa": ("spend", "conversions", 1),
            "roas": ("conversion_value", "spend", 1)}


def _rates(df: DataFrame, specs: dict) -> DataFrame:
    return df.withColumns({k: rnd(ratio(n, dn, scale=s), 6) for k, (n, dn, s) in specs.items()})


def ad_performance(delivery: DataFrame, dims: list[str], actions: DataFrame | None = None,
                   action_col: str = "action_type", action_value: str = "value",
                   conversion_actions: list[str] | None = None) -> DataFrame:
    """Delivery per dims (ad / campaign x day) with conversions pivoted from action
    rows (rolled up to the same grain first) and recomputed rates."""
    d = delivery.groupBy(*dims).agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
                                    rnd(F.sum("spend"), 2).alias("spend"))
    if actions is not None:
        conv = F.col(action_col).isin(conversion_actions or ["purchase"])
        a = actions.groupBy(*dims).agg(F.count_if(conv).alias("conversions"),
                                       rnd(F.sum(F.when(conv, F.col(action_value)).otherwise(0.0)), 2).alias("conversion_value"))
        d = join_ns(d, a, dims, "left").fillna({"conversions": 0, "conversion_value": 0.0})
    return _rates(d, AD_RATES)


def roll_up(df: DataFrame, keys: list[str], measures: list[str], ratios: dict | None = None) -> DataFrame:
    """Roll an ad-level report up to campaign / account level; rates recomputed from sums."""
    g = df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    g = g.withColumns({m: rnd(m, 2) for m, t in g.dtypes if m in measures and t == "double"})
    return _rates(g, ratios or {k: v for k, v in AD_RATES.items() if v[0] in measures and v[1] in measures})


def cross_channel(channels: dict, keys: list[str], spend: str = "spend") -> DataFrame:
    """Stack platforms into one schema; share of spend within keys (e.g. day x currency)."""
    from .windows import share_of
    parts = [df.withColumn("channel", F.lit(name)) for name, df in channels.items()]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return share_of(u, keys, spend, out="share_of_spend", digits=6)


def _email_rates(out: DataFrame, roles) -> DataFrame:
    """Delivered mails and the rates over them; a rate appears when its role was given by name."""
    delivered = F.col("sends_total") - (F.col("bounces_total") if "bounces" in roles else F.lit(0))
    out = out.withColumn("delivered", delivered)
    rates = {"delivery_rate": ("sends", "delivered", "sends_total"), "opens_rate": ("opens", "opens_unique", "delivered"),
             "clicks_rate": ("clicks", "clicks_unique", "delivered"), "clicks_to_opens_rate": ("clicks", "clicks_unique", "opens_unique"),
             "complaint_rate": ("complaints", "complaints_total", "delivered"),
             "unsubscribe_rate": ("unsubscribes", "unsubscribes_unique", "delivered")}
    return out.withColumns({name: rnd(ratio(a, b), 6) for name, (role, a, b) in rates.items()
                            if role in roles and (name != "clicks_to_opens_rate" or "opens" in roles)})


def email_campaign_performance(facts: dict, key, user: str) -> DataFrame:
    """Per campaign totals and unique users of each message event kind, each fact
    rolled up before the join. ``facts`` are named by role: sends, bounces, opens, clicks,
    complaints, unsubscribes; delivered = sends - bounces and the rates are over delivered."""
    from .aggs import rollup_facts
    parts = {k: (df, {f"{k}_total": F.count(F.lit(1)), f"{k}_unique": F.count_distinct(user)}) for k, df in facts.items()}
    return _email_rates(rollup_facts(None, parts, key, fill=0), set(facts))


def email_campaign_performance_by_kind(events: DataFrame, key, user: str, kind: str, kinds: dict) -> DataFrame:
    """D59 when the message events are rows of one table: ``kinds = {role: event kind}``;
    one scan (``rollup_kinds``), same columns and rates as ``email_campaign_performance``."""
    from .aggs import rollup_kinds
    specs = {k: {f"{n}_total": ("count", None), f"{n}_unique": ("count_distinct", user)} for n, k in kinds.items()}
    return _email_rates(rollup_kinds(events, key, kind, specs, fill=0), set(kinds))


def messaging_daily(events: DataFrame, kind: str, ts: str, dims: list[str], stages: list[str],
                    cost: str | None = None) -> DataFrame:
    """Day x dims funnel requests -> delivered -> opened -> clicked (+ cost)."""
    aggs = [F.count_if(F.col(kind) == s).alias(s) for s in stages]
    if cost:
        aggs.append(rnd(F.sum(cost), 2).alias("cost"))
    return events.groupBy(F.to_date(F.col(ts).cast("timestamp")).alias("date"), *dims).agg(*aggs)


def breakdown_performance(delivery: DataFrame, actions: DataFrame, grain: list[str], **kw) -> DataFrame:
    """The D55 report at another grain (country, placement, audience, product...)."""
    return ad_performance(delivery, grain, actions, **kw)


# Fixed value: e-mail address pattern used to parse recipients.
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[a-z]{2,}"


def thread_messages(messages: DataFrame, thread: str, order: list[str], text: str, bucket=None) -> DataFrame:
    """Per message: recipients parsed from the text (distinct, sorted), their count,
    position in the thread ascending and descending, first / last flags.

    With ``bucket`` (non-decreasing in ``order``) positions are numbered in two levels
    (``seq_number``), so one huge thread is not numbered in a single task.
    """
    from pyspark.sql.window import Window
    from .windows import seq_number
    rec = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(EMAIL_PATTERN), 0)))
    base = messages.select(*[c for c in messages.columns if c != text],
                           F.array_join(rec, ",").alias("recipient_list"), F.size(rec).alias("recipient_count"))
    if bucket is not None:
        out = seq_number(base, thread, order, "position_in_thread", bucket, desc_out="position_from_end")
        out = out.withColumns({"position_in_thread": F.col("position_in_thread").cast("int"),
                               "position_from_end": F.col("position_from_end").cast("int")})
    else:
        w = Window.partitionBy(thread).orderBy(*order)
        wd = Window.partitionBy(thread).orderBy(*[F.col(o).desc() for o in order])
        out = base.withColumns({"position_in_thread": F.row_number().over(w),
                                "position_from_end": F.row_number().over(wd)})
    return out.withColumns({"is_first": F.col("position_in_thread") == 1, "is_last": F.col("position_from_end") == 1})


def correspondents(messages: DataFrame, dims: list[str], text: str, direction: str | None = None) -> DataFrame:
    """Messages per correspondent address x dims (sent / received split when a
    direction column is given); addresses exploded from the parsed recipients."""
    rec = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(EMAIL_PATTERN), 0))
    ex = messages.select(*dims, *([direction] if direction else []), F.explode(rec).alias("address"))
    aggs = [F.count(F.lit(1)).alias("messages")]
    if direction:
        aggs += [F.count_if(F.col(direction) == "sent").alias("sent"),
                 F.count_if(F.col(direction) == "received").alias("received")]
    return ex.groupBy("address", *dims).agg(*aggs)


def campaign_roi(facts, keys: list[str], cost: str | None = None, value: str | None = None, kind: str | None = None,
                 specs: dict | None = None, money: list[str] | None = None) -> DataFrame:
    """Per key union: each fact rolled up first (proposals, content, conversions,
    payables, ...), then ROI = value / cost when both measures are given (``money`` columns are
    rounded to cents before). ``facts`` is a dict of tables (``rollup_facts``), or one table whose
    facts are told apart by ``kind`` (``specs`` as in ``rollup_kinds``), which is then read once."""
    from .aggs import rollup_facts, rollup_kinds
    out = rollup_facts(None, facts, keys, fill=0) if kind is None else rollup_kinds(facts, keys, kind, specs)
    out = out.withColumns({m: rnd(m, 2) for m in money or []})
    if cost and value:
        out = out.withColumn("roi", rnd(ratio(value, cost), 6))
    return out


def message_errors(messages: DataFrame, ts: str, code: str, dims: list[str], status: str, recipient: str) -> DataFrame:
    """Per day x dims x error code: messages with an error, failed, undelivered, distinct recipients."""
    return (messages.where(F.col(code).isNotNull() & (F.col(code) != 0))
            .groupBy(F.to_date(F.col(ts).cast("timestamp")).alias("date"), *dims, F.col(code).alias("error_code"))
            .agg(F.count(F.lit(1)).alias("messages"), F.count_if(F.col(status) == "failed").alias("failed"),
                 F.count_if(F.col(status) == "undelivered").alias("undelivered"),
                 F.count_distinct(recipient).alias("distinct_recipients")))
