"""S3: a published report that refreshes only the periods that changed.

The report is a folder with one sub-folder per period and run, and a manifest with one small row per published period and
run. A refresh reads which periods the rows of newer generations touch, rebuilds those periods from all their rows, writes
them under a new run, and then appends to the manifest: that append is the switch. A reader joins the data with the
newest run of each period, so it sees a period's old rows or its new ones, never a part. A run that finds no newer
generation writes nothing; one that dies before the manifest leaves files nobody reads, and the next run writes over them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["refresh", "published"]

PERIOD, RUN, UPTO = "_period", "_run", "_upto"
NO_PERIOD = "none"
_MANIFEST = f"{PERIOD} string, {RUN} long, {UPTO} long"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    where = f"{path}/manifest"
    return spark.read.schema(_MANIFEST).parquet(where) if _exists(spark, where) else spark.createDataFrame([], _MANIFEST)


def published(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """S3: the report as of its last refresh (and as temp view ``name``). Rows of replaced runs are left out by a join with the
    manifest's newest runs; their folders are pruned when the manifest is small enough to be broadcast."""
    path = path.rstrip("/")
    if not _exists(spark, f"{path}/schema"):
        raise ValueError(f"nothing is published at {path}")
    schema = spark.read.parquet(f"{path}/schema").schema
    if _exists(spark, f"{path}/data"):
        # folder names are text, whatever they look like
        held = spark.read.schema(T.StructType([*schema.fields, T.StructField(PERIOD, T.StringType()), T.StructField(RUN, T.LongType())])).parquet(f"{path}/data")
        newest = _manifest(spark, path).groupBy(F.col(PERIOD).alias("_mp")).agg(F.max(RUN).alias("_mr"))
        out = held.join(newest, (F.col(PERIOD) == F.col("_mp")) & (F.col(RUN) == F.col("_mr"))).select(*schema.names)
    else:
        out = spark.createDataFrame([], schema)
    if name:
        out.createOrReplaceTempView(name)
    return out


def refresh(spark: SparkSession, source: DataFrame, generation: str, period: Column, build: Callable[[DataFrame], DataFrame], path: str,
            report_period: str = "period", name: str | None = None) -> list[str]:
    """S3: bring the report at ``path`` up to ``source``; returns the periods that were rebuilt, in order (empty: nothing was written).

    ``generation``: an increasing number per load, kept on every row (rows without one are read, but are no news);
    ``period``: the part of the report a row belongs to (an expression; NULL is a period of its own); ``build``: rows of some
    periods -> the report of those periods, computed per period, with the period in column ``report_period``. Late rows of an
    old period rebuild that period, and rows the rebuilt report no longer holds disappear with it. Periods are a calendar's
    worth: the list of changed ones reaches the driver. An empty source publishes an empty report.
    """
    path = path.rstrip("/")
    last = _manifest(spark, path).agg(F.max(UPTO).alias("upto"), F.coalesce(F.max(RUN), F.lit(0)).alias("run")).first()
    rows = source.withColumn(PERIOD, F.coalesce(period.cast("string"), F.lit(NO_PERIOD)))
    news = rows.where(F.col(generation).isNotNull() if last.upto is None else F.col(generation) > last.upto)
    touched = news.groupBy(PERIOD).agg(F.max(generation).alias("upto")).collect()        # one row per changed period
    if not _exists(spark, f"{path}/schema"):
        build(source).limit(0).coalesce(1).write.parquet(f"{path}/schema")
    periods = sorted(r[PERIOD] for r in touched)
    if periods:
        run = last.run + 1
        report = build(rows.where(F.col(PERIOD).isin(periods)).drop(PERIOD))
        report = report.withColumns({PERIOD: F.coalesce(F.col(report_period).cast("string"), F.lit(NO_PERIOD)), RUN: F.lit(run).cast("long")})
        (report.repartition(PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD, RUN).parquet(f"{path}/data"))
        upto = max(r.upto for r in touched)
        spark.createDataFrame([(p, run, upto) for p in periods], _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    if name:
        published(spark, path, name)
    return periods
