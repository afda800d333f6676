"""Stored, mergeable summaries: quantile sketches (A6), exact distinct counts by bitmaps (A3, D03), most frequent values.

A day's facts are read once; weeks, months and any other period are built from the stored daily summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c_
from .sorting import sums_before

__all__ = ["KLL_K", "rank_error", "daily_quantile_sketches", "merge_quantile_sketches", "sketch_quantiles", "rank_bounds",
           "dense_ids", "daily_bitmaps", "distinct_over_periods", "most_frequent", "frequent_items"]

KLL_K = 800


def rank_error(k: int = KLL_K) -> float:
    """Stated bound on how far a quantile's true rank may lie from the asked rank, as a share of the rows. It is three
    times the sketch's own single-sided error at 99 % confidence (about 2.3 / k^0.97), so that it holds over many groups."""
    return 3 * 2.3 / k ** 0.97


def _kind(df: DataFrame, c: str) -> str:
    kind = dict(df.dtypes)[c]
    return "bigint" if kind in ("bigint", "int", "smallint", "tinyint") else "double"


def daily_quantile_sketches(df: DataFrame, dims: list[str], ts: str, c: str, k: int = KLL_K, out: str = "sketch") -> DataFrame:
    """One KLL sketch (a small binary, combined map-side) of ``c`` per ``dims`` x day; NULLs are not counted, a group
    of NULLs has no row. Store the result: every longer period is merged from it."""
    kind = _kind(df, c)
    agg = F.kll_sketch_agg_bigint(F.col(c).cast("bigint"), F.lit(k)) if kind == "bigint" else F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k))
    return df.where(F.col(c).isNotNull()).groupBy(*dims, F.to_date(F.col(ts)).alias("day")).agg(agg.alias(out), F.lit(kind).alias("kind"))


def merge_quantile_sketches(daily: DataFrame, dims: list[str], period: Column | None, kind: str, out: str = "period", c: str = "sketch") -> DataFrame:
    """Stored sketches -> one per ``dims`` x ``period`` (an expression over ``day``; None: all days)."""
    merge = F.kll_merge_agg_bigint(c) if kind == "bigint" else F.kll_merge_agg_double(c)
    return daily.groupBy(*dims, (F.lit(None).cast("date") if period is None else period).alias(out)).agg(merge.alias(c))


def sketch_quantiles(df: DataFrame, ps: dict[str, float], kind: str, c: str = "sketch", n: str = "n") -> DataFrame:
    """Answers of a sketch column: number of values, and a quantile per name in ``ps``. Quantiles are values that occur."""
    count = F.kll_sketch_get_n_bigint(c) if kind == "bigint" else F.kll_sketch_get_n_double(c)
    pick = F.kll_sketch_get_quantile_bigint if kind == "bigint" else F.kll_sketch_get_quantile_double
    return df.withColumns({n: count, **{name: pick(F.col(c), F.lit(float(p))) for name, p in ps.items()}}).drop(c)


def rank_bounds(facts: DataFrame, answers: DataFrame, keys: list[str], c: str, ps: dict[str, float], error: float) -> DataFrame:
    """Does the exact rank of every answer lie within ``error`` of the asked rank? Facts are counted against the answers
    of their group (a hash aggregate, no sort); adds ``<name>_in_bound`` to ``answers``."""
    a = answers.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(p).alias(f"_a_{p}") for p in ps])
    j = facts.where(F.col(c).isNotNull()).join(a, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    counts = j.groupBy(*[f"_k_{k}" for k in keys]).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c) < F.col(f"_a_{p}")).alias(f"_lt_{p}") for p in ps],
        *[F.count_if(F.col(c) <= F.col(f"_a_{p}")).alias(f"_le_{p}") for p in ps])
    out = answers.join(counts, [answers[k].eqNullSafe(counts[f"_k_{k}"]) for k in keys], "left")
    ok = {f"{p}_in_bound": (F.col(f"_lt_{p}") <= (q + error) * F.col("_n")) & (F.col(f"_le_{p}") >= (q - error) * F.col("_n")) for p, q in ps.items()}
    return out.withColumns(ok).select(*answers.columns, *ok)


def dense_ids(df: DataFrame, c: str, out: str = "id") -> DataFrame:
    """Every distinct non-NULL value of ``c`` with a number 0, 1, 2, ... in the order of the values.

    The values are sorted over range partitions and numbered by place (``sorting.sums_before``).
    """
    values = df.where(F.col(c).isNotNull()).select(c).distinct()
    return sums_before(values, [F.col(c)], {out: F.lit(1)})


def daily_bitmaps(df: DataFrame, dims: list[str], ts: str, user: str, ids: DataFrame | None = None) -> DataFrame:
    """Users of every ``dims`` x day as bitmaps over their dense ids, one row per 32,768 ids. A user's rows of a
    day are one before the ids are joined."""
    ids = dense_ids(df, user, "_id") if ids is None else ids
    seen = df.where(F.col(user).isNotNull()).select(user, *dims, F.to_date(F.col(ts)).alias("day")).distinct()
    return seen.join(ids, user).groupBy(*dims, "day", F.bitmap_bucket_number("_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bitmap"))


def distinct_over_periods(daily: DataFrame, dims: list[str], periods: dict[str, Column], out: str = "users") -> DataFrame:
    """Exact distinct counts for several nested periods at once: the daily bitmaps of a period are OR-ed, its bits counted.
    ``periods``: grain -> start of the period, an expression over ``day``. Returns dims, grain, period_start, ``out``."""
    grains = F.explode(F.array(*[F.struct(F.lit(g).alias("grain"), p.cast("date").alias("period_start")) for g, p in periods.items()]))
    d = daily.select(*dims, "bucket", "bitmap", grains.alias("_g")).select(*dims, "bucket", "bitmap", "_g.*")
    merged = d.groupBy(*dims, "grain", "period_start", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*dims, "grain", "period_start").agg(F.sum(F.bitmap_count("bitmap")).alias(out))


def most_frequent(df: DataFrame, keys: list[str], c: str, out: str | None = None, count_out: str | None = None) -> DataFrame:
    """Exact most frequent non-NULL value per group, ties to the smallest value; NULL for a group without values.

    Counted per (group, value) first, so a group's different values are spread over the tasks and never held in one
    buffer; then one row per value is compared.
    """
    counts = df.groupBy(*keys, c_(c).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    order = F.when(F.col("_v").isNotNull(), F.struct((-F.col("_n")).alias("less"), F.col("_v").alias("v")))
    best = counts.groupBy(*keys).agg(F.min(order).alias("_b"))
    return best.select(*keys, F.col("_b.v").alias(out or c), *([F.coalesce(-F.col("_b.less"), F.lit(0)).alias(count_out)] if count_out else []))


def frequent_items(df: DataFrame, dims: list[str], ts: str, c: str, period: Column, share: float, tracked: int | None = None) -> DataFrame:
    """Every value that fills at least ``share`` of its ``dims`` x period, with its exact count.

    A frequent-items sketch of at most ``tracked`` values is accumulated per day and combined per period, so memory is
    bounded whatever the number of different values. A sketch of m counters, combined or not, names every value with more
    than 7 / m of the rows (m is at least ``16 / share``); its candidates are recounted exactly in a second pass, and
    those below ``share`` go.
    """
    tracked = tracked or max(64, 1 << (int(16 / share) - 1).bit_length())
    rows = df.where(F.col(c).isNotNull()).withColumn("_day", F.to_date(F.col(ts)))
    daily = rows.groupBy(*dims, "_day").agg(F.expr(f"approx_top_k_accumulate(`{c}`, {tracked})").alias("_s"))
    merged = daily.groupBy(*dims, period.alias("period")).agg(F.expr(f"approx_top_k_combine(_s, {tracked})").alias("_s"))
    cand = merged.select(*[F.col(x).alias(f"_k_{x}") for x in [*dims, "period"]], F.expr(f"explode(approx_top_k_estimate(_s, {tracked}))").alias("_i"))
    cand = cand.select(*[f"_k_{x}" for x in [*dims, "period"]], F.col("_i.item").alias("_item"))
    facts = rows.withColumn("period", period)
    total = facts.groupBy(*dims, "period").agg(F.count(F.lit(1)).alias("_n"))
    same = [F.col(x).eqNullSafe(F.col(f"_k_{x}")) for x in [*dims, "period"]]
    exact = facts.join(cand, same + [F.col(c) == F.col("_item")], "left_semi").groupBy(*dims, "period", c).agg(F.count(F.lit(1)).alias("n"))
    t = total.select(*[F.col(x).alias(f"_k_{x}") for x in [*dims, "period"]], "_n")
    return exact.join(t, same).where(F.col("n") >= F.lit(share) * F.col("_n")).select(*dims, "period", c, "n", (F.col("n") / F.col("_n")).alias("share"))
