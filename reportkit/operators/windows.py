"""Window operators.

Every window here is partitioned by an entity key. Where a per-key group could
be unbounded on raw facts (latest-row de-dup, ordered picks) the operator is a
hash aggregate instead (``max_by`` over a struct), which combines map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import c_, rnd
from ..session import tasks_for


def _l(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def _ord(order) -> list[Column]:
    out = []
    for o in _l(order):
        if isinstance(o, str) and o.startswith("-"):
            out.append(F.col(o[1:]).desc())
        else:
            out.append(c_(o))
    return out


def dedup_latest(df: DataFrame, keys, order_by) -> DataFrame:
    """Newest row per key by ``order_by`` (ascending columns; include a unique last key).

    Hash aggregate ``max_by(row, order)``: partial aggregation collapses
    duplicates before the shuffle, so a key with millions of copies never sorts
    in one task.
    """
    keys = _l(keys)
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[c_(o) for o in _l(order_by)])).alias("_r"))
            .select(*keys, "_r.*"))


def pick_one(df: DataFrame, keys, order) -> DataFrame:
    """One row per key by a multi-key priority; ``'-col'`` means descending
    (F4: the window column is filtered right after, the ``QUALIFY`` pattern)."""
    w = Window.partitionBy(*_l(keys)).orderBy(*_ord(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def rank_within(df: DataFrame, part, order, out: str = "rank") -> DataFrame:
    """RANK within a partition."""
    return df.withColumn(out, F.rank().over(Window.partitionBy(*_l(part)).orderBy(*_ord(order))))


def number_rows(df: DataFrame, part, order, out: str = "row_number", desc: bool = False,
                bucket: Column | None = None) -> DataFrame:
    """Position in sequence, ascending or descending (``bucket``: two-level, see ``seq_number``)."""
    if bucket is not None:
        if desc:
            return seq_number(df, part, _l(order), "_asc", bucket, desc_out=out).drop("_asc")
        return seq_number(df, part, _l(order), out, bucket)
    o = [x.desc() for x in _ord(order)] if desc else _ord(order)
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*_l(part)).orderBy(*o)))


def prev(df: DataFrame, part, order, c: str, out: str | None = None, n: int = 1,
         bucket: Column | None = None) -> DataFrame:
    """LAG (``bucket``: two-level previous row, see ``seq_neighbors``)."""
    if bucket is not None and n == 1:
        return seq_neighbors(df, part, _l(order), [c], bucket, prev_prefix="_pv_", next_prefix=None
                             ).withColumnRenamed(f"_pv_{c}", out or f"prev_{c}")
    return df.withColumn(out or f"prev_{c}", F.lag(c, n).over(Window.partitionBy(*_l(part)).orderBy(*_ord(order))))


def next_(df: DataFrame, part, order, c: str, out: str | None = None, n: int = 1,
          bucket: Column | None = None) -> DataFrame:
    """LEAD (``bucket``: two-level next row, see ``seq_neighbors``)."""
    if bucket is not None and n == 1:
        return seq_neighbors(df, part, _l(order), [c], bucket, prev_prefix=None, next_prefix="_nx_"
                             ).withColumnRenamed(f"_nx_{c}", out or f"next_{c}")
    return df.withColumn(out or f"next_{c}", F.lead(c, n).over(Window.partitionBy(*_l(part)).orderBy(*_ord(order))))


def period_change(df: DataFrame, part, order: str, cols: list[str], calendar: str | None = None,
                  digits: int | None = None) -> DataFrame:
    """Change and growth vs the previous row, or vs the previous calendar month.

    ``calendar='month'``: the previous value counts only when the previous row is
    exactly the previous calendar month (a gap month gives NULL rather than the
    older row) -- a calendar self-join, done as one gap-guarded
    LAG so the input is read once.
    """
    part = _l(part)
    if calendar == "month":
        w = Window.partitionBy(*part).orderBy(order)
        is_prev = F.lag(order).over(w) == F.add_months(F.col(order), -1)
        out = df.withColumns({f"prev_{c}": F.when(is_prev, F.lag(c).over(w)) for c in cols})
    else:
        w = Window.partitionBy(*part).orderBy(order)
        out = df.withColumns({f"prev_{c}": F.lag(c).over(w) for c in cols})
    for c in cols:
        chg = F.col(c) - F.col(f"prev_{c}")
        gr = F.try_divide(chg.cast("double"), F.nullif(F.col(f"prev_{c}").cast("double"), F.lit(0.0)))
        out = out.withColumns({f"{c}_change": chg,
                               f"{c}_growth": rnd(gr, digits) if digits is not None else gr})
    return out


def daily_change(df: DataFrame, part, date: str, c: str, mode: str = "gap_guarded",
                 out: str | None = None) -> DataFrame:
    """Day-over-day change only when the previous row is exactly the previous day
    (``gap_guarded``), or against the last earlier non-NULL value (``last_value``)."""
    w = Window.partitionBy(*_l(part)).orderBy(date)
    name = out or f"{c}_change"
    if mode == "gap_guarded":
        return df.withColumn(name, F.when(F.lag(date).over(w) == F.date_sub(F.col(date), 1),
                                          F.col(c) - F.lag(c).over(w)))
    w2 = w.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.col(c) - F.last(c, ignorenulls=True).over(w2))


def change_points(df: DataFrame, keys, order, c: str, bucket: Column | None = None) -> DataFrame:
    """Keep the first row and rows whose value differs from the previous (NULLs dropped).
    With ``bucket`` the previous value comes from the two-level ``seq_neighbors``."""
    if bucket is not None:
        d = seq_neighbors(df.where(F.col(c).isNotNull()), keys, _l(order), [c], bucket, prev_prefix="_p_",
                          next_prefix=None)
        return d.where(F.col(f"_p_{c}").isNull() | (F.col(f"_p_{c}") != F.col(c))).drop(f"_p_{c}")
    w = Window.partitionBy(*_l(keys)).orderBy(*_ord(order))
    return (df.where(F.col(c).isNotNull())
            .withColumn("_p", F.lag(c).over(w))
            .where(F.col("_p").isNull() | (F.col("_p") != F.col(c))).drop("_p"))


def running_total(df: DataFrame, part, order, c: str, out: str | None = None, reset=None,
                  bucket: Column | None = None) -> DataFrame:
    """Cumulative sum; ``reset`` (a column) restarts it (e.g. fiscal year);
    ``bucket``: two-level, see ``seq_running_sum``."""
    p = _l(part) + ([reset] if reset is not None else [])
    if bucket is not None:
        return seq_running_sum(df, p, _l(order), c, out or f"running_{c}", bucket)
    w = Window.partitionBy(*p).orderBy(*_ord(order)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out or f"running_{c}", F.sum(c).over(w))


def opening_balance(df: DataFrame, part, order, c: str, out: str = "opening") -> DataFrame:
    """Cumulative up to the previous row (0 for the first)."""
    w = Window.partitionBy(*_l(part)).orderBy(*_ord(order)).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(c).over(w), F.lit(0)))


def back_cast(df: DataFrame, part, order, delta: str, total: str, out: str = "backcast_total") -> DataFrame:
    """today's total minus every later delta (level reconstructed backwards)."""
    w = Window.partitionBy(*_l(part)).orderBy(*_ord(order)).rowsBetween(1, Window.unboundedFollowing)
    return df.withColumn(out, F.col(total) - F.coalesce(F.sum(delta).over(w), F.lit(0)))


def trailing_agg(df: DataFrame, part, date: str, c: str, days: int, fn: str = "sum",
                 include_current: bool = True, out: str | None = None) -> DataFrame:
    """Value-based RANGE window over day numbers (gap-safe)."""
    hi = 0 if include_current else -1
    lo = -(days - 1) if include_current else -days
    w = Window.partitionBy(*_l(part)).orderBy(F.unix_date(F.col(date).cast("date"))).rangeBetween(lo, hi)
    return df.withColumn(out or f"{fn}_{c}_{days}d", getattr(F, fn)(c).over(w))


_MERGE = {"sum": ("sum", "sum"), "count": ("count", "sum"), "min": ("min", "min"), "max": ("max", "max")}


def trailing_over_days(df: DataFrame, part, date: str, c: str, days: int, fn: str = "sum", include_current: bool = True,
                       out: str | None = None) -> DataFrame:
    """W12 in two levels, for keys of any size: a key's rows are summed per day first (a hash aggregate), the RANGE frame
    runs over its days, and rows get their day's figure back by equality. ``fn``: sum, count, min, max or avg. Equal to
    ``trailing_agg``; rows without a date form a frame of their own."""
    if fn == "avg":
        d = trailing_over_days(df, part, date, c, days, "sum", include_current, "_sum")
        d = trailing_over_days(d, part, date, c, days, "count", include_current, "_cnt")
        return d.withColumn(out or f"avg_{c}_{days}d", F.try_divide(F.col("_sum").cast("double"), F.col("_cnt"))).drop("_sum", "_cnt")
    first, then = _MERGE[fn]
    keys = _l(part)
    d = df.withColumn("_day", F.unix_date(F.col(date).cast("date")))
    g = d.groupBy(*keys, "_day").agg(getattr(F, first)(c).alias("_x"))
    lo, hi = (-(days - 1), 0) if include_current else (-days, -1)
    x = getattr(F, then)("_x").over(Window.partitionBy(*keys).orderBy("_day").rangeBetween(lo, hi))
    name = out or f"{fn}_{c}_{days}d"
    g = g.select(*keys, "_day", (F.coalesce(x, F.lit(0)) if fn == "count" else x).alias(name))
    return _ns_join(d, g, keys + ["_day"]).drop("_day")


def trailing_window(df: DataFrame, part, ts: str, c: str, seconds: int, fn: str = "sum", out: str | None = None) -> DataFrame:
    """W12 over timestamps: ``fn`` of ``c`` over the rows of the last ``seconds`` up to and with the row's own moment.

    Time is cut into buckets as long as the frame, so a frame reaches its own bucket and the one before; every row stands
    in its bucket and once more, as history, in the next. Windows run per key x bucket: a hot key is spread over its time,
    no partition holds more than two frames' rows, and any aggregate is exact."""
    keys = _l(part)
    width = seconds * 1_000_000
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    d = df.withColumns({"_t": t, "_own": F.floor(t / width)})
    d = d.withColumn("_bucket", F.explode(F.when(F.col("_own").isNull(), F.array("_own")).otherwise(F.array(F.col("_own"), F.col("_own") + 1))))
    w = Window.partitionBy(*keys, "_bucket").orderBy("_t").rangeBetween(-width, 0)
    d = d.withColumn(out or f"{fn}_{c}_{seconds}s", getattr(F, fn)(c).over(w))
    return d.where(F.col("_bucket").eqNullSafe(F.col("_own"))).drop("_t", "_own", "_bucket")


def carry_forward(df: DataFrame, part, order, cols: list[str], suffix: str = "") -> DataFrame:
    """Last non-NULL value at or before the row."""
    w = Window.partitionBy(*_l(part)).orderBy(*_ord(order)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c + suffix: F.last(c, ignorenulls=True).over(w) for c in cols})


def first_in(df: DataFrame, part, order, c: str, out: str | None = None, ignore_nulls: bool = True) -> DataFrame:
    """First (non-NULL) value of the partition."""
    w = Window.partitionBy(*_l(part)).orderBy(*_ord(order)).rowsBetween(Window.unboundedPreceding,
                                                                       Window.unboundedFollowing)
    return df.withColumn(out or f"first_{c}", F.first(c, ignorenulls=ignore_nulls).over(w))


def max_before(df: DataFrame, part, order, c: str, out: str | None = None) -> DataFrame:
    """Maximum over all earlier rows."""
    w = Window.partitionBy(*_l(part)).orderBy(*_ord(order)).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out or f"max_prior_{c}", F.max(c).over(w))


def next_when(df: DataFrame, part, order, cond: Column, c: str, out: str) -> DataFrame:
    """Earliest later row's ``c`` among rows meeting ``cond`` (min over the following frame)."""
    w = Window.partitionBy(*_l(part)).orderBy(*_ord(order)).rowsBetween(1, Window.unboundedFollowing)
    return df.withColumn(out, F.min(F.when(cond, F.col(c))).over(w))


def share_of(df: DataFrame, part, c: str, out: str | None = None, digits: int | None = None) -> DataFrame:
    """X / SUM(x) over the partition (NULL on zero total); applied to a grouped
    result it is the aggregate-over-an-aggregate pattern."""
    tot = F.sum(c).over(Window.partitionBy(*_l(part)))
    r = F.try_divide(F.col(c).cast("double"), F.nullif(tot.cast("double"), F.lit(0.0)))
    return df.withColumn(out or f"share_of_{c}", rnd(r, digits) if digits is not None else r)


def flag_extreme(df: DataFrame, part, c: str, which: str = "max", out: str | None = None) -> DataFrame:
    """Flag rows equal to the partition max/min (e.g. month-end, first day)."""
    e = (F.max if which == "max" else F.min)(c).over(Window.partitionBy(*_l(part)))
    return df.withColumn(out or f"is_{which}_{c}", F.col(c) == e)


def _ns_join(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be NULL (IS NOT DISTINCT FROM)."""
    o = other.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in other.columns])
    cond = [df[k].eqNullSafe(o[f"_k_{k}"]) for k in keys]
    return df.join(o, cond, "left").drop(*[f"_k_{k}" for k in keys])


def seq_neighbors(df: DataFrame, keys, order: list[str], cols: list[str], bucket: Column,
                  prev_prefix: str | None = "prev_", next_prefix: str | None = "next_") -> DataFrame:
    """LAG / LEAD of ``cols`` per key in ``order``, computed in two levels so that no
    task sorts a whole (possibly hot) key.

    ``bucket`` must be non-decreasing in ``order`` (e.g. the day or hour of the
    timestamp). Rows are windowed per (key, bucket); the first / last row of every
    bucket is found by a hash aggregate (min / max of a struct that sorts like
    ``order``) and a key's bucket rows -- bounded by its time span, not its volume --
    supply the neighbour across bucket boundaries. Equivalent to a single window per
    key.
    """
    keys = _l(keys)
    s = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c) for c in cols])
    d = df.withColumns({"_bk": bucket, "_s": s})
    w = Window.partitionBy(*keys, "_bk").orderBy(*order)
    wb = Window.partitionBy(*keys).orderBy("_bk")
    agg = d.groupBy(*keys, "_bk").agg(F.min("_s").alias("_first"), F.max("_s").alias("_last"))
    agg = agg.select(*keys, "_bk", F.lag("_last").over(wb).alias("_p_out"), F.lead("_first").over(wb).alias("_n_out"))
    d = d.withColumns({"_p_in": F.lag("_s").over(w), "_n_in": F.lead("_s").over(w)})
    d = _ns_join(d, agg, keys + ["_bk"])
    out = {}
    for c in cols:
        if prev_prefix is not None:
            out[prev_prefix + c] = F.coalesce(F.col("_p_in"), F.col("_p_out"))[c]
        if next_prefix is not None:
            out[next_prefix + c] = F.coalesce(F.col("_n_in"), F.col("_n_out"))[c]
    return d.withColumns(out).drop("_bk", "_s", "_p_in", "_n_in", "_p_out", "_n_out")


def seq_next_when(df: DataFrame, keys, order: list[str], cond: Column, c: str, out: str, bucket: Column) -> DataFrame:
    """W16 in two levels: the smallest ``c`` among strictly later rows meeting ``cond``
    (``c`` non-decreasing in ``order``, e.g. the timestamp). Within the row's (key,
    bucket) window plus a suffix minimum over the key's later bucket aggregates."""
    keys = _l(keys)
    d = df.withColumn("_bk", bucket)
    hit = F.when(cond, F.col(c))
    w = Window.partitionBy(*keys, "_bk").orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    d = d.withColumn("_in", F.min(hit).over(w))
    agg = d.groupBy(*keys, "_bk").agg(F.min(hit).alias("_bmin"))
    wb = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(1, Window.unboundedFollowing)
    agg = agg.select(*keys, "_bk", F.min("_bmin").over(wb).alias("_later"))
    d = _ns_join(d, agg, keys + ["_bk"])
    return d.withColumn(out, F.least("_in", "_later")).drop("_bk", "_in", "_later")


def seq_running_sum(df: DataFrame, keys, order: list[str], c: str, out: str, bucket: Column) -> DataFrame:
    """W9 in two levels: running sum per (key, bucket) plus the totals of the key's
    earlier buckets (a window over bucket aggregates, bounded by the bucket count)."""
    keys = _l(keys)
    d = df.withColumn("_bk", bucket)
    w = Window.partitionBy(*keys, "_bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_local", F.sum(c).over(w))
    agg = d.groupBy(*keys, "_bk").agg(F.sum(c).alias("_bsum"))
    wb = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    agg = agg.select(*keys, "_bk", F.coalesce(F.sum("_bsum").over(wb), F.lit(0)).alias("_before"))
    d = _ns_join(d, agg, keys + ["_bk"])
    return d.withColumn(out, F.col("_local") + F.col("_before")).drop("_bk", "_local", "_before")


def seq_running_min(df: DataFrame, keys, order: list[str], c: str, out: str, bucket: Column, before_out: str | None = None) -> DataFrame:
    """Running minimum per key in two levels, like ``seq_running_sum``; ``before_out`` also gives the minimum over the
    rows strictly before."""
    keys = _l(keys)
    d = df.withColumn("_bk", bucket)
    w = Window.partitionBy(*keys, "_bk").orderBy(*order)
    d = d.withColumns({"_upto": F.min(c).over(w.rowsBetween(Window.unboundedPreceding, 0)),
                       "_under": F.min(c).over(w.rowsBetween(Window.unboundedPreceding, -1))})
    agg = d.groupBy(*keys, "_bk").agg(F.min(c).alias("_bmin"))
    wb = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    agg = agg.select(*keys, "_bk", F.min("_bmin").over(wb).alias("_before"))
    d = _ns_join(d, agg, keys + ["_bk"])
    d = d.withColumn(out, F.least("_upto", "_before"))
    if before_out:
        d = d.withColumn(before_out, F.least("_under", "_before"))
    return d.drop("_bk", "_upto", "_under", "_before")


def seq_number(df: DataFrame, keys, order: list[str], out: str, bucket: Column,
               desc_out: str | None = None) -> DataFrame:
    """W4 in two levels: ROW_NUMBER per key = position inside its (key, bucket) plus the
    row counts of the key's earlier buckets; ``desc_out`` also gives the position
    counted from the end. ``bucket`` must be non-decreasing in ``order``."""
    keys = _l(keys)
    d = df.withColumn("_one", F.lit(1))
    d = seq_running_sum(d, keys, order, "_one", out, bucket).drop("_one")
    if desc_out:
        tot = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tot"))
        d = _ns_join(d, tot, keys).withColumn(desc_out, F.col("_tot") - F.col(out) + 1).drop("_tot")
    return d


def seq_carry_forward(df: DataFrame, keys, order: list[str], c: str, out: str, bucket: Column, tasks: int | None = None,
                      first_out: str | None = None) -> DataFrame:
    """W13 in two levels: last non-NULL ``c`` at or before each row, per key. Inside a
    (key, bucket) window, then from the key's earlier buckets (each bucket's last
    non-NULL value, carried over the bucket rows of the key). ``first_out`` also gives the
    key's first non-NULL ``c``, at or after the row included. Every step is dealt to ``tasks`` partitions
    (``tasks_for(df)`` if not given); key and bucket are one struct, whose equality takes NULLs as values."""
    keys = _l(keys)
    order = [o for o in order if o not in keys]
    n = tasks or tasks_for(df)
    # the hash comes first because numbers sort faster than structs; it is made again after a shuffle, not carried
    at = ["_h", "_at"]

    def dealt(rows):
        return rows.repartition(n, F.xxhash64("_at"), "_at").withColumn("_h", F.xxhash64("_at"))

    d = dealt(df.withColumn("_at", F.struct(*keys, bucket.alias("_bk"))).drop(*keys))
    w = Window.partitionBy(*at).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ordering = F.when(F.col(c).isNotNull(), F.struct(*[F.col(o) for o in order]))
    agg = d.groupBy(*at).agg(F.max_by(c, ordering).alias("_blast"), F.min_by(c, ordering).alias("_bfirst"))
    per_key = Window.partitionBy(*keys).orderBy("_bk")
    agg = agg.select("_at", "_at.*", "_blast", "_bfirst").repartition(n, *keys).select(
        "_at", F.last("_blast", ignorenulls=True).over(per_key.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_bfirst", ignorenulls=True).over(per_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_of_key"))
    d = d.withColumn("_in", F.last(c, ignorenulls=True).over(w)).join(dealt(agg), at, "left")
    new = {out: F.coalesce("_in", "_before"), **({first_out: F.col("_of_key")} if first_out else {})}
    back = [F.col("_at")[k].alias(k) if k in keys else F.col(k) for k in df.columns if k not in new]
    return d.select(*back, *[x.alias(k) for k, x in new.items()])


def seq_prev_and_next_when(df: DataFrame, keys, order: list[str], prev_cols: list[str], cond: Column, c: str,
                           out: str, bucket: Column, prev_prefix: str = "prev_") -> DataFrame:
    """``seq_neighbors`` (previous row's ``prev_cols``) and ``seq_next_when`` (smallest
    later ``c`` meeting ``cond``) in one two-level pass: one bucket aggregate and one
    join back, so the input is consumed twice instead of four times."""
    keys = _l(keys)
    s = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(x) for x in prev_cols])
    hit = F.when(cond, F.col(c))
    d = df.withColumns({"_bk": bucket, "_s": s, "_hit": hit})
    w = Window.partitionBy(*keys, "_bk").orderBy(*order)
    d = d.withColumns({"_p_in": F.lag("_s").over(w),
                       "_in": F.min("_hit").over(w.rowsBetween(1, Window.unboundedFollowing))})
    agg = d.groupBy(*keys, "_bk").agg(F.max("_s").alias("_last"), F.min("_hit").alias("_bmin"))
    wb = Window.partitionBy(*keys).orderBy("_bk")
    agg = agg.select(*keys, "_bk", F.lag("_last").over(wb).alias("_p_out"),
                     F.min("_bmin").over(wb.rowsBetween(1, Window.unboundedFollowing)).alias("_later"))
    d = _ns_join(d, agg, keys + ["_bk"])
    prev = F.coalesce(F.col("_p_in"), F.col("_p_out"))
    return (d.withColumns({**{prev_prefix + x: prev[x] for x in prev_cols}, out: F.least("_in", "_later")})
            .drop("_bk", "_s", "_hit", "_p_in", "_in", "_p_out", "_later"))


def seq_next_when_many(df: DataFrame, keys, order: list[str], conds: dict, c: str, bucket: Column) -> DataFrame:
    """Several W16 look-aheads (``conds = {out: condition}``) in one two-level pass:
    one window, one bucket aggregate, one join back."""
    keys = _l(keys)
    d = df.withColumns({"_bk": bucket, **{f"_h_{o}": F.when(cnd, F.col(c)) for o, cnd in conds.items()}})
    w = Window.partitionBy(*keys, "_bk").orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    d = d.withColumns({f"_in_{o}": F.min(f"_h_{o}").over(w) for o in conds})
    agg = d.groupBy(*keys, "_bk").agg(*[F.min(f"_h_{o}").alias(f"_b_{o}") for o in conds])
    wb = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(1, Window.unboundedFollowing)
    agg = agg.select(*keys, "_bk", *[F.min(f"_b_{o}").over(wb).alias(f"_l_{o}") for o in conds])
    d = _ns_join(d, agg, keys + ["_bk"])
    d = d.withColumns({o: F.least(f"_in_{o}", f"_l_{o}") for o in conds})
    return d.drop("_bk", *[f"_{p}_{o}" for o in conds for p in ("h", "in", "l")])
