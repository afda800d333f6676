"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every reportkit job relies on. AQE re-plans joins and partition
# counts from runtime sizes; the skew-join split handles hot keys on the probe
# side of sort-merge joins.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "reportkit", cores: int | str | None = None,
              shuffle_partitions: int | None = None,
              driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks; clusters pass their own session."""
    cores = cores or os.environ.get("BENCH_CPUS", "*")
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) is a private folder created.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for cluster runs")
        d = tempfile.mkdtemp(prefix="reportkit-ckpt-")  # local mode only (tests, bench)
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


ROWS_A_TASK = 50_000


def tasks_for(rows: DataFrame, rows_a_task: int = ROWS_A_TASK) -> int:
    """Partitions for a step whose rows grow with those of ``rows`` (counted): as many as the default parallelism, and so many that a
    task's share stays the same on larger tables. An explicit ``repartition`` of that many is not merged by AQE, which looks at
    shuffled bytes only and not at what a task makes of them."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // rows_a_task))


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle / scan sizing for a cluster run.

    Shuffle partitions are sized so that each holds about ``target_partition_bytes``
    of the input (never fewer than 2 waves of the cluster's cores); AQE then
    coalesces small ones and splits skewed ones (a partition 5x the median and over
    ``4 x target`` is split by the skew-join rule). Scans read splits of the same
    target size.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
