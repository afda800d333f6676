"""Array / JSON row operators (the scalar helpers N2, N4, N6, N7 are in
``reportkit.functions.columns``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_json(df: DataFrame, c: str, schema: str | None = None, path: str | None = None,
                 pos: bool = True, keep_empty: bool = False, out: str = "item",
                 where=None, key: str | None = None, at: str | None = None) -> DataFrame:
    """JSON text -> one row per element of the array (or entry of the object) at ``path``.

    The text is parsed once, without a schema, into a VARIANT; ``path`` is ``$.a.b`` or, for lists inside
    lists, ``$.a[*].b``: every ``[*]`` explodes one level (a final one is implied). Elements may be of unlike
    types: ``out`` is a VARIANT, or of type ``schema`` (NULL where an element can't be read as that).
    ``pos`` adds the 0-based position (``pos_1``, ``pos_2``, ... outermost first, if there are several levels;
    entries of an object stand in the order of their keys), ``key`` names a column for an object's key, ``at``
    one for the element's own path.
    Malformed text, a missing path, a scalar there, and empty lists yield no rows, or one row with NULLs with
    ``keep_empty``. ``where`` filters the elements (N3: e.g. only people-type entries).
    """
    steps = (path or "$").removeprefix("$").split("[*]")
    if len(steps) > 1 and not steps[-1]:
        steps.pop()
    explode = df.sparkSession.tvf.variant_explode_outer if keep_empty else df.sparkSession.tvf.variant_explode
    # generated columns are called pos, key, value: the input's own names step aside meanwhile
    rest = {f"_c{i}": x for i, x in enumerate(df.columns)}
    d = df.toDF(*rest).withColumns({"_v": F.try_parse_json(F.col(f"_c{df.columns.index(c)}")), "_at": F.lit("$")})
    kept = list(rest)
    for i, step in enumerate(steps, 1):
        d = d.withColumn("_v", F.try_variant_get("_v", "$" + step, "variant")).lateralJoin(explode(F.col("_v").outer()))
        here = F.concat("_at", F.lit(step), F.coalesce(F.concat(F.lit("."), F.col("key")), F.concat(F.lit("["), F.col("pos"), F.lit("]"))))
        d = d.select(*kept, F.col("value").alias("_v"), here.alias("_at"), F.col("pos").alias(f"_p{i}"), F.col("key").alias("_k"))
        kept.append(f"_p{i}")
    value = F.col("_v") if schema is None else F.try_variant_get("_v", "$", schema)
    names = {f"_p{i}": "pos" if len(steps) == 1 else f"pos_{i}" for i in range(1, len(steps) + 1)} if pos else {}
    res = d.select(*[F.col(k).alias(v) for k, v in {**rest, **names}.items()], value.alias(out),
                   *([F.col("_k").alias(key)] if key else []), *([F.col("_at").alias(at)] if at else []))
    return res.where(where) if where is not None else res


def explode_arrays(df: DataFrame, cols: list[str], out: str = "value", distinct: bool = False) -> DataFrame:
    """Explode the union (concatenation) of several array columns."""
    arr = F.concat(*[F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType)) for c in cols])
    if distinct:
        arr = F.array_distinct(arr)
    rest = [x for x in df.columns if x not in cols]
    return df.select(*rest, F.explode(arr).alias(out))
