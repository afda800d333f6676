"""Binding names to data, multi-account unions, published views, seeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_source(spark: SparkSession, base_dir: str, name: str, fmt: str = "parquet",
                columns: list[str] | None = None, view: bool = True) -> DataFrame:
    """Bind a logical table name to a file set (and register a temp view).

    Column selection is lazy; Catalyst still prunes and pushes filters into the
    Parquet scan for whatever the downstream plan really uses.
    """
    path = f"{base_dir.rstrip('/')}/{name}.{fmt}"
    df = spark.read.format(fmt).load(path)
    if columns:
        df = df.select(*columns)
    if view:
        df.createOrReplaceTempView(name)
    return df


def union_sources(frames: dict[str, DataFrame], tag: str = "source_account") -> DataFrame:
    """Stack the same stream from several accounts, labelling each row."""
    tagged = [df.withColumn(tag, F.lit(label)) for label, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def publish(df: DataFrame, name: str, where=None, mode: str = "view",
            path: str | None = None) -> DataFrame:
    """S3: expose a stable contract name, optionally filtered.

    ``mode='table'`` materialises to Parquet at ``path`` (a shared location) and
    returns the re-read table, which is how a reused model is cut from its
    lineage.
    """
    out = df.where(where) if where is not None else df
    if mode == "table":
        if not path:
            raise ValueError("mode='table' needs a path")
        out.write.mode("overwrite").parquet(path)
        out = df.sparkSession.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out


SEED_ROWS = 10_000


def seed(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Small constant lookup; broadcast up to ``SEED_ROWS`` rows."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= SEED_ROWS else df


def with_settings(df: DataFrame, **consts) -> DataFrame:
    """A one-row settings relation expressed as literal columns (constant folded)."""
    return df.withColumns({k: F.lit(v) for k, v in consts.items()})


def cross_settings(df: DataFrame, settings: DataFrame) -> DataFrame:
    """Attach a data-derived one-row relation (e.g. spine bounds) without collect()."""
    if settings.limit(2).count() != 1:
        raise ValueError("settings must be exactly one row")
    return df.crossJoin(F.broadcast(settings))


def bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str) -> DataFrame:
    """Materialise ``df`` as a table bucketed (and sorted) on ``keys`` at a shared ``path``.

    Two facts bucketed on the same key with the same bucket count join without a
    shuffle on either side (e.g. lineitem and orders on the order key), and
    aggregations on that key reuse the layout.
    """
    (df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)
