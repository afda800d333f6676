"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def _hang(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m is the smallest of u and its neighbours (summed up before the shuffle)."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(low, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) -> (u, root): the smallest node reachable from every node with an edge.

    Each round hangs larger neighbours, then smaller ones, under the smallest known node; the
    table never holds more rows than edges, and the number of rounds grows with the logarithm
    of the longest path. Nodes that are their own root are not listed.
    """
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .where("u <> v").distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hang(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _hang(large)
        step = written(small.select("u", F.col("m").alias("v"))
                       .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                       .distinct())
        drop_written(now)
        now = step
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(seen) == mark:
            return now.select("u", F.col("v").alias("root"))
        mark = tuple(seen)
