"""Re-run-and-keep-newest on Structured Streaming.

Each micro-batch of newly landed raw rows is appended to a table with a generation
number (the batch id); the published report reads that table and keeps the newest
generation per key (W1, a hash aggregate). The stream's checkpoint lives under the
cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import dedup_latest
from ..session import ensure_checkpoint_dir


def append_generations(spark: SparkSession, source_dir: str, schema, table_path: str, name: str,
                       fmt: str = "parquet", available_now: bool = True):
    """Start a stream that appends every new file's rows with ``_generation`` = batch id."""
    ckpt = ensure_checkpoint_dir(spark).rstrip("/") + f"/streams/{name}"
    stream = spark.readStream.format(fmt).schema(schema).load(source_dir)

    def write(batch: DataFrame, batch_id: int):
        batch.withColumn("_generation", F.lit(batch_id).cast("long")).write.mode("append").parquet(table_path)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def latest_generation(spark: SparkSession, table_path: str, keys: list[str]) -> DataFrame:
    """Newest generation of every key (ties resolved by the row itself)."""
    t = spark.read.parquet(table_path)
    return dedup_latest(t, keys, ["_generation"]).drop("_generation")
