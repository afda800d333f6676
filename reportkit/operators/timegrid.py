"""T1, T2, T7 (calendar spines and grids) and R1/R2 (bounded recursion)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _step(step: str) -> Column:
    return {"day": F.expr("INTERVAL 1 DAY"), "week": F.expr("INTERVAL 7 DAY"),
            "month": F.expr("INTERVAL 1 MONTH")}[step]


def spine(df: DataFrame, start, end, step: str = "day", out: str = "period") -> DataFrame:
    """Every period between ``start`` and ``end`` (aggregate Columns over ``df``,
    or literals). The bounds stay a one-row relation -- never collected to the driver."""
    s = start if isinstance(start, Column) else F.lit(start).cast("date")
    e = end if isinstance(end, Column) else F.lit(end).cast("date")
    bounds = df.agg(s.cast("date").alias("_s"), e.cast("date").alias("_e"))
    return bounds.select(F.explode(F.sequence("_s", "_e", _step(step))).alias(out))


def densify(facts: DataFrame, entity, period: str, measures: list[str], end=None,
            step: str = "day", start=None, fill=0, end_floor_to_start: bool = True) -> DataFrame:
    """Entity x period grid, each entity from its own first period to ``end``.

    ``facts`` hold at most one row per (entity, period). ``end``: literal / Column
    (e.g. ``as_of``), or None = the data's global max period. A fact after ``end`` extends
    its entity's grid, so none is dropped.

    Single pass over ``facts``: fact rows inside the grid are kept, and the entity's first row
    (found with a window per entity, bounded by its periods) also emits the whole
    period sequence; one hash aggregate per (entity, period) then merges the grid
    row with the fact row. The facts are therefore read once (twice only when the
    global end has to be derived from them).
    """
    from pyspark.sql.window import Window
    ent = [entity] if isinstance(entity, str) else list(entity)
    f = facts.where(F.col(period).isNotNull())
    others = [c for c in f.columns if c not in ent + [period]]
    s_col = (start if isinstance(start, Column) else F.lit(start).cast("date")) if start is not None \
        else F.min(period).over(Window.partitionBy(*ent))
    f = f.withColumn("_s", s_col)
    if end is None:
        gmax = facts.agg(F.max(period).alias("_e"))
        f = f.crossJoin(F.broadcast(gmax))  # one-row relation
    else:
        f = f.withColumn("_e", end if isinstance(end, Column) else F.lit(end).cast("date"))
    f = f.withColumn("_last", F.max(period).over(Window.partitionBy(*ent)))
    e = F.greatest("_e", "_last")
    e = F.greatest(e, F.col("_s")) if end_floor_to_start else e
    # the entity's first fact row carries the grid (one per entity, even with a start override)
    f = f.withColumn("_first", F.row_number().over(Window.partitionBy(*ent).orderBy(period)) == 1)
    first = F.col("_first")
    ptype = f.schema[period].dataType.simpleString()
    grid = F.when(first, F.sequence(F.col("_s"), e, _step(step))).otherwise(F.array().cast(f"array<{ptype}>"))
    in_grid = F.col(period) >= F.col("_s")  # facts before an explicit start are not part of the grid
    items = F.concat(
        F.when(in_grid, F.array(F.struct(F.col(period).alias("p"), F.lit(True).alias("is_fact"))))
        .otherwise(F.array().cast(f"array<struct<p:{ptype},is_fact:boolean>>")),
        F.transform(grid, lambda x: F.struct(x.alias("p"), F.lit(False).alias("is_fact"))))
    rows = f.select(*ent, *others, F.explode(items).alias("_x"))
    rows = rows.select(*ent, F.col("_x.p").alias(period),
                       *[F.when(F.col("_x.is_fact"), F.col(c)).alias(c) for c in others])
    out = rows.groupBy(*ent, period).agg(*[F.max(c).alias(c) for c in others])
    if fill is not None:
        out = out.withColumns({m: F.coalesce(F.col(m), F.lit(fill)) for m in measures})
    return out


def events_from_timestamps(df: DataFrame, ts_measures: dict, keys: list[str],
                           date_fn=None, out_date: str = "date") -> DataFrame:
    """One entity contributes to several days (created, started, closed, ...).

    One scan: each row emits an array of (date, measure) pairs that is exploded and
    aggregated -- instead of one union branch (and one scan) per timestamp.
    ``ts_measures = {timestamp column: measure name}``; returns keys x date x counts.
    """
    to_date = date_fn or (lambda c: F.to_date(c))
    arr = F.array(*[F.struct(to_date(F.col(ts)).alias("d"), F.lit(m).alias("m")) for ts, m in ts_measures.items()])
    ex = df.select(*keys, F.explode(arr).alias("_e")).where(F.col("_e.d").isNotNull())
    return (ex.groupBy(*keys, F.col("_e.d").alias(out_date))
            .agg(*[F.count_if(F.col("_e.m") == m).alias(m) for m in ts_measures.values()]))


def _double(table: DataFrame, combine) -> DataFrame:
    """Pointer doubling to a fixed point.

    ``table`` has ``s`` (node), ``a`` (the node its pointer reached, NULL once it has
    settled) and payload columns. Each round joins the rows that still move with the
    table itself, so a pointer covers twice the distance: log2(longest chain) rounds, each
    checkpointed into the shared checkpoint dir so the plan stays linear. A pointer that
    still moves after more steps than there are nodes is in a loop or leads into one;
    such rows keep a non-NULL ``a``.
    """
    table = cut_lineage(table)
    nodes, steps = table.count(), 1
    while steps <= nodes and not table.where("a IS NOT NULL").isEmpty():
        x = table.where("a IS NOT NULL").alias("x")
        moved = x.join(table.alias("y"), F.col("x.a") == F.col("y.s"), "left")
        table = cut_lineage(table.where("a IS NULL").unionByName(
            moved.select(F.col("x.s").alias("s"), F.col("y.a").alias("a"), *combine)))
        steps *= 2
    return table


def flatten_tree(df: DataFrame, id_col: str, parent_col: str, name_col: str, sep: str = " > ") -> DataFrame:
    """Walk parent pointers to the root; path root->node, depth, root id.

    Pointer doubling (``_double``) over the ancestor chains, of any depth. A missing
    parent ends the chain. Nodes on or below a loop have no root: ``in_loop`` is true and
    root, path and depth are NULL.
    """
    nodes = df.select(F.col(id_col).alias("s"), F.col(parent_col).alias("p"), F.col(name_col).alias("nm"))
    ids = nodes.select(F.col("s").alias("p"), F.lit(True).alias("_ok")).distinct()
    t = (nodes.join(ids, "p", "left")
         .select("s", F.when(F.col("_ok"), F.col("p")).alias("a"),
                 F.array(F.col("s")).alias("ids"), F.array(F.col("nm")).alias("names")))
    t = _double(t, [F.concat("x.ids", "y.ids").alias("ids"), F.concat("x.names", "y.names").alias("names")])
    loop = F.col("a").isNotNull()
    path = F.reverse("names")

    def rooted(c):
        return F.when(~loop, c)

    return t.select(F.col("s").alias("node_id"), rooted(F.element_at("ids", -1)).alias("root_id"),
                    rooted(F.array_join(path, sep)).alias("path"), rooted(F.size("names")).alias("depth"),
                    rooted(F.element_at(path, 1)).alias("root_name"), loop.alias("in_loop"))


def follow_chain(df: DataFrame, id_col: str, next_col: str) -> DataFrame:
    """R2: follow successor ids to the final record, however long the chain.

    Returns (id, final_id, hops, in_loop). A successor that does not exist ends the chain;
    a record in a loop, or leading into one, has no final record: ``in_loop`` is true and
    final_id and hops are NULL.
    """
    links = cut_lineage(df.select(F.col(id_col).alias("s"), F.col(next_col).alias("n")))
    ids = links.select(F.col("s").alias("n"), F.lit(True).alias("_ok")).distinct()
    t = (links.join(ids, "n", "left")
         .select("s", F.when(F.col("_ok"), F.col("n")).alias("a"),
                 F.when(F.col("_ok"), F.col("n")).otherwise(F.col("s")).alias("t"),
                 F.when(F.col("_ok"), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("h")))
    t = _double(t, [F.col("y.t").alias("t"), (F.col("x.h") + F.col("y.h")).alias("h")])
    loop = F.col("a").isNotNull()
    return t.select(F.col("s").alias("id"), F.when(~loop, F.col("t")).alias("final_id"),
                    F.when(~loop, F.col("h")).alias("hops"), loop.alias("in_loop"))
