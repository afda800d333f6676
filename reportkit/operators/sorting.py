"""Work on a global order without one task that holds it: running sums over range partitions, ranks (W3), range joins.

A table is dealt to range partitions and sorted there; what a row has before it is what its partition has before it plus
the totals of the partitions before. Only those totals (one row per partition) are ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

__all__ = ["sums_before", "rank_over_ranges", "range_sweep_join", "range_totals", "distinct_after"]

SLICE = 1024        # neighbouring point values that are compared with the ranges of one slice


def _order(order: list) -> list[Column]:
    return [o if isinstance(o, Column) else F.col(o[1:]).desc() if o.startswith("-") else F.col(o) for o in order]


def sums_before(df: DataFrame, order: list, sums: dict[str, Column]) -> DataFrame:
    """``df`` with, per name in ``sums``, the sum of that expression over all rows before in ``order`` (0 for the first).

    ``order`` should tell all rows apart (equal rows can't be split over partitions, and their order is open). The sorted
    table is checkpointed first, so that places can't move when a task is run again.
    """
    by = _order(order)
    d = cut_lineage(df.withColumns({f"_s_{k}": v for k, v in sums.items()}).repartitionByRange(*by).sortWithinPartitions(*by)
                    .withColumn("_at", F.monotonically_increasing_id()))
    d = d.withColumn("_part", F.shiftright("_at", 33))
    parts = d.groupBy("_part").agg(*[F.sum(f"_s_{k}").alias(f"_t_{k}") for k in sums])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)        # one row per partition
    parts = parts.select(F.col("_part").alias("_p"), *[F.coalesce(F.sum(f"_t_{k}").over(earlier), F.lit(0)).alias(f"_b_{k}") for k in sums])
    here = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumns({f"_h_{k}": F.coalesce(F.sum(f"_s_{k}").over(here), F.lit(0)) for k in sums})
    d = d.join(F.broadcast(parts), F.col("_part") == F.col("_p"))
    return d.select(*df.columns, *[(F.col(f"_b_{k}") + F.col(f"_h_{k}")).alias(k) for k in sums])


def _same(a: DataFrame, b: DataFrame, cols: list[str]) -> list[Column]:
    return [a[c].eqNullSafe(b[f"_k_{c}"]) for c in cols]


def rank_over_ranges(df: DataFrame, part: list[str], order: list, out: str | None = "rank", dense_out: str | None = None) -> DataFrame:
    """RANK and DENSE_RANK of every row within ``part`` by ``order`` (column names, ``'-c'`` descending), for parts of any size.

    Ties are counted first (one row per part and value), so a tie is never cut by a partition's edge; the values are sorted
    over range partitions, and a part's first place is taken off. NULLs order and group like in a window.
    """
    cols = [o.lstrip("-") for o in order]
    keys = list(dict.fromkeys([*part, *cols]))
    values = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    placed = sums_before(values, [*part, *order], {"_rows": F.col("_n"), "_values": F.lit(1)})
    if part:
        first = placed.groupBy(*[F.col(p).alias(f"_k_{p}") for p in part]).agg(F.min("_rows").alias("_r0"), F.min("_values").alias("_v0"))
        placed = placed.join(first, _same(placed, first, part))
    else:
        placed = placed.withColumns({"_r0": F.lit(0), "_v0": F.lit(0)})
    ranks = placed.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                          *([(F.col("_rows") - F.col("_r0") + 1).alias(out)] if out else []),
                          *([(F.col("_values") - F.col("_v0") + 1).alias(dense_out)] if dense_out else []))
    return df.join(ranks, _same(df, ranks, keys)).select(*[df[c] for c in df.columns], *[x for x in (out, dense_out) if x])


def range_sweep_join(a: DataFrame, b: DataFrame, point: str, lo: str, hi: str, closed: str = "[)", how: str = "inner",
                     slice_values: int = SLICE) -> DataFrame:
    """J5 without equality keys: rows of ``a`` with the rows of ``b`` whose ``[lo, hi)`` (or ``[lo, hi]``) holds ``point``.

    The different points and the ranges' ends are swept once in sorted order, so every range becomes a run of places
    ``[first, last)`` among the points. Points are cut into slices of ``slice_values`` neighbours; a range is copied to the
    slices it reaches, each of which holds at least one of its points, and meets the points there by equality of the slice.
    So at most two slices of a range are compared in vain, whatever the number of points, and an open or hot range costs no
    more rows than it has matches. Facts are shuffled once, on the point. Any type that sorts will do.

    NULL ``lo`` / ``hi``: open on that side; NULL point: no match; an empty or reversed range matches nothing;
    ``how='left'`` keeps points without a range. ``a`` and ``b`` must not share column names.
    """
    after = 0 if closed == "[)" else 2          # ends sort before (0) or after (2) the points (1) they equal
    pts = a.where(F.col(point).isNotNull()).select(F.col(point).alias("_x")).distinct().withColumn("_kind", F.lit(1))
    ends = b.select(F.col(lo).alias("_x"), F.lit(0).alias("_kind")).unionByName(b.select(F.col(hi).alias("_x"), F.lit(after).alias("_kind")))
    ends = ends.where(F.col("_x").isNotNull()).distinct()
    swept = sums_before(pts.unionByName(ends), ["_x", "_kind"], {"_pos": (F.col("_kind") == 1).cast("int")})
    places = swept.where(F.col("_kind") == 1).select("_x", "_pos")
    total = places.agg(F.coalesce(F.max("_pos") + 1, F.lit(0)).alias("_total"))                 # one row
    edge = lambda kind, c, out: swept.where(F.col("_kind") == kind).select(F.col("_x").alias(c), F.col("_pos").alias(out))
    starts, stops = edge(0, "_lo", "_first"), edge(after, "_hi", "_last")
    r = b.join(starts, b[lo] == starts["_lo"], "left").join(stops, b[hi] == stops["_hi"], "left").crossJoin(F.broadcast(total))
    r = r.withColumns({"_first": F.when(b[lo].isNull(), F.lit(0)).otherwise(F.col("_first")),
                       "_last": F.when(b[hi].isNull(), F.col("_total")).otherwise(F.col("_last"))}).where(F.col("_first") < F.col("_last"))
    cut = lambda c: F.floor(c / slice_values)
    r = r.select(*[b[c] for c in b.columns], "_first", "_last", F.explode(F.sequence(cut(F.col("_first")), cut(F.col("_last") - 1))).alias("_slice"))
    p = places.withColumn("_cut", cut(F.col("_pos")))
    pairs = p.join(r, (F.col("_cut") == F.col("_slice")) & (F.col("_pos") >= F.col("_first")) & (F.col("_pos") < F.col("_last")))
    pairs = pairs.select(F.col("_x"), *b.columns)
    return a.join(pairs, a[point] == pairs["_x"], how).drop("_x")


def range_totals(a: DataFrame, b: DataFrame, point: str, lo: str, hi: str, sums: dict[str, Column], closed: str = "[)",
                 unmatched: bool = False) -> DataFrame:
    """J5 summed per range, without the pairs: the columns of ``b`` with, per name in ``sums``, the sum of that expression over
    the rows of ``a`` whose ``point`` lies in the range (whole numbers: a total is the difference of two running sums).

    Rows of ``a`` are added up per different point, which are swept with the ranges' different ends in sorted order; every
    end learns the sums of the points before it. So rows, ranges and result are moved once each, however many rows a range
    holds. Bounds and NULLs are those of ``range_sweep_join``; a range that holds no row has no row. ``unmatched`` adds one row
    (NULL in the columns of ``b``) with the sums over rows of ``a`` in no range, if there are any.
    """
    after = 0 if closed == "[)" else 2          # ends sort before (0) or after (2) the points (1) they equal
    names = list(sums)
    zero = [F.lit(0).cast("long").alias(n) for n in ["_rows", *names]]
    flat = a.select(F.col(point).alias("_x"), *[v.cast("long").alias(n) for n, v in sums.items()])
    pts = flat.groupBy("_x").agg(F.count(F.lit(1)).alias("_rows"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    # ranges that hold no value at all would open and close out of order
    holds = b[lo].isNull() | b[hi].isNull() | ((b[lo] < b[hi]) if closed == "[)" else (b[lo] <= b[hi]))
    r = b.where(holds)
    ends = r.select(F.explode(F.array(F.struct(F.col(lo).alias("x"), F.lit(0).alias("kind"), F.lit(1).alias("open")),
                                      F.struct(F.col(hi).alias("x"), F.lit(after).alias("kind"), F.lit(-1).alias("open")))).alias("e"))
    ends = ends.where("e.x IS NOT NULL").groupBy(F.col("e.x").alias("_x"), F.col("e.kind").alias("_kind")).agg(
        F.sum("e.open").cast("long").alias("_open"))
    line = pts.where(F.col("_x").isNotNull()).select("_x", F.lit(1).alias("_kind"), "_rows", *names, F.lit(0).cast("long").alias("_open"))
    line = line.unionByName(ends.select("_x", "_kind", *zero, "_open"))
    swept = sums_before(line, ["_x", "_kind"], {f"_b_{n}": F.col(n) for n in ["_rows", *names, "_open"]})
    total = swept.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(f"_t_{n}") for n in ["_rows", *names]])        # one row

    def edge(kind, c, tag):
        return swept.where(F.col("_kind") == kind).select(F.col("_x").alias(c), *[F.col(f"_b_{n}").alias(f"{tag}{n}") for n in ["_rows", *names]])

    starts, stops = edge(0, "_lo", "_f_"), edge(after, "_hi", "_l_")
    r = r.join(starts, r[lo] == starts["_lo"], "left").join(stops, r[hi] == stops["_hi"], "left").crossJoin(F.broadcast(total))
    upto = {n: F.when(b[hi].isNull(), F.col(f"_t_{n}")).otherwise(F.col(f"_l_{n}")) - F.when(b[lo].isNull(), F.lit(0)).otherwise(F.col(f"_f_{n}"))
            for n in ["_rows", *names]}
    out = r.where(upto["_rows"] > 0).select(*[b[c] for c in b.columns], *[upto[n].alias(n) for n in names])
    if not unmatched:
        return out
    # open ranges: those without a start are open before the first end
    always = r.agg(F.count_if(b[lo].isNull()).alias("_always"))                                             # one row
    free = swept.where(F.col("_kind") == 1).crossJoin(F.broadcast(always)).where(F.col("_b__open") + F.col("_always") == 0)
    free = free.select("_rows", *names).unionByName(pts.where(F.col("_x").isNull()).select("_rows", *names))
    free = free.agg(F.sum("_rows").alias("_rows"), *[F.sum(n).alias(n) for n in names]).where(F.col("_rows") > 0)
    return out.unionByName(free.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in b.schema.fields], *names))


def distinct_after(a: DataFrame, b: DataFrame, key: str, ts: str, owner: str, opened: str, closed: str, length: Column, out: str) -> DataFrame:
    """Per ``owner``: the different non-NULL ``key`` s of the rows of ``a`` inside its windows ``[opened, closed)``, all of them
    ``length`` long; without pairs where an owner has one window.

    A key is seen by a window if its first row at or after ``opened`` is less than ``length`` away, so a row stands for the openings in
    ``(previous row of the key, row]``, at most ``length`` back: one piece per key and moment, no two of a key sharing an opening.
    The keys of a window are the pieces its opening lies in, a difference of running sums. Several windows of one owner are cut at
    the next opening, so that a row lies in one of them at most, and joined with the rows. A window without ends holds every row
    that has a moment.
    """
    from .windows import seq_neighbors
    day = lambda c: F.to_date(F.col(c).cast("timestamp"))
    seen = a.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).alias("_key"), F.col(ts).alias("_ts")).distinct()
    w = b.select(F.col(owner).alias("_owner"), F.col(opened).alias("_open"), F.col(closed).alias("_close")).distinct()
    kinds = w.groupBy("_owner").agg(F.count(F.lit(1)).alias("_n"), F.bool_or(F.col("_open").isNull()).alias("_all"), F.min("_open").alias("_open"))

    pieces = seq_neighbors(seen, "_key", ["_ts"], ["_ts"], day("_ts"), "_prev", None)
    start = F.greatest(F.col("_prev_ts"), F.col("_ts") - length)
    steps = pieces.select(F.explode(F.array(F.struct(start.alias("x"), F.lit(1).alias("step")), F.struct(F.col("_ts").alias("x"), F.lit(-1).alias("step")))).alias("e"))
    steps = steps.groupBy(F.col("e.x").alias("_x")).agg(F.sum("e.step").cast("long").alias("_step")).withColumn("_kind", F.lit(1))
    one = kinds.where((F.col("_n") == 1) & ~F.col("_all")).select("_owner", "_open")
    line = steps.unionByName(one.select(F.col("_open").alias("_x"), F.lit(0).cast("long").alias("_step"), F.lit(0).alias("_kind")).distinct())
    swept = sums_before(line, ["_x", "_kind"], {out: F.col("_step")}).where(F.col("_kind") == 0)
    counts = one.join(swept, one["_open"] == swept["_x"]).select("_owner", out)

    every = seen.agg(F.count_distinct("_key").alias(out))                                                   # one row
    counts = counts.unionByName(kinds.where("_all").crossJoin(F.broadcast(every)).select("_owner", out))
    more = kinds.where((F.col("_n") > 1) & ~F.col("_all")).select(F.col("_owner").alias("_o"))
    if not more.isEmpty():
        cut = w.join(more, w["_owner"].eqNullSafe(more["_o"]), "left_semi")
        cut = seq_neighbors(cut, "_owner", ["_open"], ["_open"], day("_open"), None, "_next")
        cut = cut.select("_owner", "_open", F.least("_close", "_next_open").alias("_until"))
        met = range_sweep_join(seen, cut, "_ts", "_open", "_until").groupBy("_owner").agg(F.count_distinct("_key").alias(out))
        met = more.join(met, more["_o"].eqNullSafe(met["_owner"]), "left").select(F.col("_o").alias("_owner"), F.coalesce(out, F.lit(0)).alias(out))
        counts = counts.unionByName(met)
    return counts.withColumnRenamed("_owner", owner)
