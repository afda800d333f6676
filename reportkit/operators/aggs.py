"""DataFrame-level aggregation operators.

(Aggregate *expressions* A2-A9, A12, A14 live in ``reportkit.functions.aggregates``.)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c_, rnd


def _l(x):
    return [x] if isinstance(x, str) else list(x)


def group_agg(df: DataFrame, keys, aggs: dict) -> DataFrame:
    """A1: ``aggs = {out_name: Column aggregate}``."""
    return df.groupBy(*_l(keys)).agg(*[a.alias(n) for n, a in aggs.items()])


def pivot_kv(df: DataFrame, keys, key_col: str, value_col: str, mapping: dict,
             fn: str = "max") -> DataFrame:
    """A10: long (key, value) rows -> one column per mapped key.

    Written as conditional aggregates over an explicit key list: one pass, no
    distinct-values discovery job, partial aggregation intact.
    """
    agg = getattr(F, fn)
    return df.groupBy(*_l(keys)).agg(*[
        agg(F.when(F.col(key_col) == F.lit(k), F.col(value_col))).alias(out) for k, out in mapping.items()])


def with_ratios(df: DataFrame, specs: dict, digits: int | None = None) -> DataFrame:
    """Rates recomputed from summed parts: ``{out: (num, den, scale)}``."""
    cols = {}
    for out, spec in specs.items():
        num, den = spec[0], spec[1]
        scale = spec[2] if len(spec) > 2 else 1
        r = F.try_divide(c_(num).cast("double") * F.lit(float(scale)), F.nullif(c_(den).cast("double"), F.lit(0.0)))
        cols[out] = rnd(r, digits) if digits is not None else r
    return df.withColumns(cols)


def distinct_keys(df: DataFrame, keys) -> DataFrame:
    """A13."""
    return df.select(*_l(keys)).distinct()


def rollup_facts(base: DataFrame | None, facts: dict, on, fill: float | None = 0) -> DataFrame:
    """Aggregate every fact to the shared key *before* joining (no fan-out).

    ``facts = {name: (df, {out: agg Column})}``. With ``base=None`` the key spine
    is the distinct union of the facts' keys (U2).
    """
    keys = _l(on)
    rolled = [d.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()]) for d, aggs in facts.values()]
    from .joins import join_ns
    if base is None:
        # key union by (NULL-safe) full outer joins: each roll-up is read once (a separate
        # distinct key set would re-read every fact)
        out = reduce(lambda a, r: join_ns(a, r, keys, "full"), rolled)
    else:
        out = reduce(lambda a, r: join_ns(a, r, keys, "left"), rolled, base)
    if fill is not None:
        names = [n for _, aggs in facts.values() for n in aggs]
        out = out.withColumns({n: F.coalesce(F.col(n), F.lit(fill)) for n in names})
    return out


def rollup_kinds(df: DataFrame, keys, kind_col: str, specs: dict, fill: float | None = 0) -> DataFrame:
    """A15 when every fact lives in one table, told apart by ``kind_col``: one scan and
    one hash aggregate of conditional aggregates instead of one roll-up (and one
    scan) per fact. ``specs = {kind: {out: (fn, column or None)}}`` with ``fn`` one of
    count / sum / min / max / avg / count_distinct; the key set is the union of the
    kinds' keys, as with ``rollup_facts``.
    """
    kinds = list(specs)
    src = df.where(F.col(kind_col).isin(kinds))
    aggs = []
    for kind, outs in specs.items():
        hit = F.col(kind_col) == F.lit(kind)
        for out, (fn, col) in outs.items():
            if fn == "count":
                aggs.append(F.count_if(hit).alias(out))
            elif fn == "count_distinct":
                aggs.append(F.count_distinct(F.when(hit, c_(col))).alias(out))
            else:
                aggs.append(getattr(F, fn)(F.when(hit, c_(col))).alias(out))
    g = src.groupBy(*_l(keys)).agg(*aggs)
    if fill is not None:
        g = g.withColumns({out: F.coalesce(F.col(out), F.lit(fill)) for outs in specs.values() for out in outs})
    return g
