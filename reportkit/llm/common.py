"""Small helpers shared by the text operators."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportkit.session import ensure_checkpoint_dir

SPACE_WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package also where only the driver's sys.path holds it, and hand them texts in batches of
    8 MB instead of the default 64 MB (a value set by the user stays): workers hold several copies of a batch."""
    if spark.conf.get(_BATCH) == f"{64 << 20}b":
        spark.conf.set(_BATCH, str(8 << 20))
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet below ``spark.checkpoint.dir`` and reread it.

    The folder is shared, so a lost executor costs only the tasks it was running. Parquet
    is several times smaller than a checkpoint of rows, and it keeps statistics.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` once nothing reads it any more."""
    spark = df.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(docs: DataFrame, *cols: str) -> DataFrame:
    """``cols`` plus ``_row``, a number per row: doc_id may be null or occur twice.

    The number follows the file order, so ``docs`` must be read from files (or be
    ``written``), not be the result of a shuffle that could come out in another order.
    """
    return docs.select(F.monotonically_increasing_id().alias("_row"), *cols)


def plain_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Columns renamed to c0, c1, ... so that no name of the input can clash; and old name -> new name."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names
