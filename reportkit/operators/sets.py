"""Set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_events(parts: dict, fill: dict | None = None, label: str = "row_type") -> DataFrame:
    """Several facts cast to one schema; missing measures NULL (or ``fill``); row label."""
    tagged = [df.withColumn(label, F.lit(name)) for name, df in parts.items()]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    if fill:
        out = out.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in fill.items()})
    return out


def key_union(dfs: list[DataFrame], keys: list[str]) -> DataFrame:
    """Distinct union of the key sets of several facts (each side de-duplicated first)."""
    return reduce(lambda a, b: a.unionByName(b), [d.select(*keys).distinct() for d in dfs]).distinct()


def append_row(report: DataFrame, summary: DataFrame) -> DataFrame:
    """Append computed summary rows (missing columns NULL)."""
    return report.unionByName(summary, allowMissingColumns=True)
