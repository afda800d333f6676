"""Join operators.

Broadcast policy: no operator forces a broadcast of a data-derived side. Catalyst
broadcasts a side only when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks with runtime sizes;
above that the plan stays a shuffle (sort-merge) join, whose hot keys AQE's
skew-join splits. ``small=True`` is reserved for fixed-size seeds / settings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c_


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def inner_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Match facts, dropping orphans on purpose."""
    return a.join(b, _keys(on), "inner")


def unique_on(dim: DataFrame, on, order=None) -> DataFrame:
    """Make a lookup unique on its key (deterministically: max of ``order``, else of the row).

    A hash aggregate with a partial phase, so a duplicated hot key is collapsed
    map-side instead of being sorted in one task.
    """
    keys = _keys(on)
    rest = [c for c in dim.columns if c not in keys]
    if not rest:
        return dim.select(*keys).distinct()
    ordering = F.struct(*[c_(o) for o in order]) if order else F.struct(*[F.col(c) for c in rest])
    return (dim.groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_row"))
            .select(*keys, "_row.*"))


# Rows of a dimension up to which it is broadcast.
BROADCAST_ROWS = 100_000


def bounded_broadcast(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``dim`` with a broadcast hint if it really is small; unhinted (an ordinary shuffled join)
    otherwise. At most ``max_rows + 1`` rows are counted."""
    return F.broadcast(dim) if dim.limit(max_rows + 1).count() <= max_rows else dim


def enrich(df: DataFrame, dim: DataFrame, on, cols: list[str] | None = None,
           prefix: str | None = None, dedupe: bool = True, small: bool = False,
           how: str = "left") -> DataFrame:
    """Left join to a dimension made unique on its key (no fan-out).

    ``prefix`` renames the dimension's columns (role-playing dimension joined twice).
    ``small=True``: broadcast if its rows are few (checked).
    """
    keys = _keys(on)
    d = dim.select(*keys, *(cols or [c for c in dim.columns if c not in keys]))
    if dedupe:
        d = unique_on(d, keys)
    if prefix:
        d = d.select(*keys, *[F.col(c).alias(prefix + c) for c in d.columns if c not in keys])
    if small:
        d = bounded_broadcast(d)
    return df.join(d, keys, how)


def merge_full(dfs: list[DataFrame], on, fill: dict | float | None = 0) -> DataFrame:
    """Full outer merge on shared keys (keys coalesced by USING), zero-filled measures."""
    keys = _keys(on)
    out = reduce(lambda a, b: a.join(b, keys, "full"), dfs)
    if fill is None:
        return out
    measures = [c for c in out.columns if c not in keys]
    if isinstance(fill, dict):
        return out.fillna(fill)
    return out.withColumns({m: F.coalesce(F.col(m), F.lit(fill)) for m in measures
                            if dict(out.dtypes)[m] in ("double", "float", "int", "bigint", "smallint", "tinyint")
                            or dict(out.dtypes)[m].startswith("decimal")})


def cross_join(a: DataFrame, b: DataFrame, small: bool = False) -> DataFrame:
    """Period x entity grid or settings row. Prefer per-entity ``densify`` for grids.
    ``small=True``: ``b`` is broadcast if its rows are few (checked)."""
    return a.crossJoin(bounded_broadcast(b) if small else b)


def range_join(a: DataFrame, b: DataFrame, on, point: str, lo: str, hi: str,
               closed: str = "[)", bucket_days: int | None = None, how: str = "inner", seed: bool = False) -> DataFrame:
    """Equality keys plus ``point`` inside ``[lo, hi)`` (or ``[lo, hi]``).

    With equality keys the range is a residual predicate of a hash/sort-merge
    join. With ``bucket_days`` (dates), each range is exploded onto the buckets it
    overlaps and the match becomes an equi-join on (keys, bucket) plus the
    residual, so no nested-loop join is ever planned. ``hi`` NULL = open-ended.
    ``how='left'`` keeps points without a covering range (each point has one bucket,
    so a range still matches a point at most once). Without keys and buckets the points and ranges are
    swept in sorted order (``sorting.range_sweep_join``); ``seed=True`` says that ``b`` is a seed of a few
    fixed rows, which is cheaper to compare in place.
    """
    keys = _keys(on) if on else []
    if not keys and not bucket_days and not seed:
        from .sorting import range_sweep_join
        return range_sweep_join(a, b, point, lo, hi, closed, how)
    lo_c, hi_c, p_c = F.col(lo), F.col(hi), F.col(point)
    if bucket_days:
        # ranges explode onto buckets, but never past the last bucket any point can
        # fall in (a one-row bound from the points): open-ended ranges stay bounded
        a = a.withColumn("_bk", F.floor(F.unix_date(p_c.cast("date")) / bucket_days).cast("int"))
        bound = a.agg(F.max("_bk").alias("_bmax"))
        lo_b = F.floor(F.unix_date(lo_c.cast("date")) / bucket_days).cast("int")
        hi_b = F.floor(F.unix_date(hi_c.cast("date")) / bucket_days).cast("int")
        b = (b.crossJoin(F.broadcast(bound))
             .withColumn("_bk", F.explode(F.sequence(lo_b, F.greatest(lo_b, F.least(F.coalesce(hi_b, F.col("_bmax")),
                                                                                  F.col("_bmax"))))))
             .drop("_bmax"))
        keys = keys + ["_bk"]
    # key columns of the right side are renamed so the result keeps the left's
    bb = b.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in b.columns])
    upper = (a[point] < bb[hi]) if closed == "[)" else (a[point] <= bb[hi])
    cond = [a[k] == bb[f"_r_{k}"] for k in keys] + [a[point] >= bb[lo], bb[hi].isNull() | upper]
    out = a.join(bb, cond, how).drop(*[f"_r_{k}" for k in keys])
    return out.drop("_bk") if bucket_days else out


def asof_join(a: DataFrame, b: DataFrame, on, a_time: str, b_time: str, cols: list[str],
              fallback: str | None = "earliest", bucket: str = "month", distinct_points: bool = False,
              tasks: int | None = None) -> DataFrame:
    """For each row of ``a`` the ``b`` row effective at or before ``a_time``.

    No inequality join and no pairs: the distinct (key, time) points of ``a`` are
    unioned with the history rows and the last effective value is carried forward
    in time order (``seq_carry_forward``: per key x ``bucket`` of time, then across
    the key's buckets), so a key with a huge history or many points is spread
    over its time buckets. ``fallback='earliest'`` takes the key's earliest row when
    nothing was effective yet (carried by the same step); ``None`` leaves NULL. Facts
    join back on (key, time) as an equi-join, unless ``distinct_points`` says that ``a`` has
    one row, or a few, per (key, time): then its rows themselves are the points, with their other
    columns (NULL keys are values there). ``tasks``: see ``seq_carry_forward``.
    """
    from .windows import seq_carry_forward
    keys = _keys(on)
    rest = [c for c in a.columns if c not in keys + [a_time]] if distinct_points else []
    row = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(None).cast("int")
    pts = a.select(*keys, F.col(a_time).alias("_t"), row.alias("_a"))
    if not distinct_points:
        pts = pts.distinct()
    hist = b.select(*keys, F.col(b_time).alias("_t"), F.struct(*[F.col(c) for c in cols]).alias("_v"))
    u = (pts.withColumns({"_v": F.lit(None).cast(hist.schema["_v"].dataType), "_o": F.lit(1)})
         .unionByName(hist.withColumns({"_a": F.lit(None).cast(pts.schema["_a"].dataType), "_o": F.lit(0)})))
    bk = F.trunc(F.to_date(F.col("_t").cast("timestamp")), bucket) if bucket in ("month", "year", "week") \
        else F.to_date(F.col("_t").cast("timestamp"))
    earliest = fallback == "earliest"
    u = seq_carry_forward(u, keys, ["_t", "_o"], "_v", "_asof", bk, tasks, "_first" if earliest else None)
    res = u.where(F.col("_o") == 1)
    if earliest:    # a NULL key has no earliest row
        known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
        res = res.withColumn("_asof", F.coalesce("_asof", F.when(known, F.col("_first"))))
    if distinct_points:     # the facts are the points: no join back
        back = {a_time: F.col("_t"), **{c: F.col("_a")[c] for c in rest}}
        return res.select(*[back.get(c, F.col(c)).alias(c) for c in a.columns], *[F.col("_asof")[c].alias(c) for c in cols])
    res = res.select(*keys, F.col("_t").alias(a_time), "_asof")
    return a.join(res, keys + [a_time], "left").select("*", *[F.col("_asof")[c].alias(c) for c in cols]).drop("_asof")


def trailing_join(facts: DataFrame, key_cols: list[str], date_col: str, n: int,
                  out_col: str = "window_date") -> DataFrame:
    """Each (key, date) fact is emitted onto the ``n`` days whose trailing window holds it.

    ``n`` is a small fixed window length, so the output is bounded by n x input.
    """
    return facts.select(*key_cols, date_col,
                        F.explode(F.sequence(F.col(date_col), F.date_add(F.col(date_col), n - 1))).alias(out_col))


def anti_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Rows of ``a`` with no match in ``b``."""
    return a.join(b.select(*_keys(on)), _keys(on), "left_anti")


def semi_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Restrict ``a`` to keys present in ``b``."""
    return a.join(b.select(*_keys(on)), _keys(on), "left_semi")


def join_ns(a: DataFrame, b: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join whose keys may be NULL on both sides (IS NOT DISTINCT FROM)."""
    keys = _keys(on)
    bb = b.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in b.columns])
    cond = [a[k].eqNullSafe(bb[f"_r_{k}"]) for k in keys]
    out = a.join(bb, cond, how)
    if how in ("full", "full_outer", "outer", "right"):
        out = out.withColumns({k: F.coalesce(F.col(k), F.col(f"_r_{k}")) for k in keys})
    return out.drop(*[f"_r_{k}" for k in keys])


def primary_association(df: DataFrame, assoc: DataFrame, key: str, target: str,
                        order: list) -> DataFrame:
    """Attach one associated entity per key, chosen by ``order`` (first = highest)."""
    best = (assoc.groupBy(key)
            .agg(F.max_by(F.col(target), F.struct(*[c_(o) for o in order])).alias(target)))
    return df.join(best, key, "left")
