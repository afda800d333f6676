"""Shared helpers for the driver-table bindings (plans).

A *plan* binds report operators to the driver's Parquet tables and returns the
report DataFrame; its twin SQL string (DuckDB dialect) is the independent oracle.
Temporal output columns are rendered as ISO text on both sides so the two
engines' date/timestamp types compare value for value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Bind a driver table (no temp view: plans compose DataFrames)."""
    from ..sources import read_source
    return read_source(spark, sf_dir, name, view=False)


def finalize(df: DataFrame) -> DataFrame:
    """Render DATE as 'yyyy-MM-dd' and TIMESTAMP as 'yyyy-MM-dd HH:mm:ss.SSSSSS'."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# DuckDB-side renderers used inside the oracle SQL strings
def sql_date(x: str) -> str:
    return f"strftime(CAST({x} AS DATE), '%Y-%m-%d')"


def sql_ts(x: str) -> str:
    return f"strftime(CAST({x} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"


def sql_secs(a: str, b: str) -> str:
    """Whole elapsed seconds (truncating), matching Spark's timestamp_diff."""
    return f"((epoch_us(CAST({b} AS TIMESTAMP)) - epoch_us(CAST({a} AS TIMESTAMP))) // 1000000)"


def expand_round(sql: str) -> str:
    """Rewrite every ``ROUND(x, d)`` of an oracle string to decimal half-up rounding,
    the same rule as ``reportkit.functions.rnd`` (engine-independent on x.xx5)."""
    out, i, key = [], 0, "ROUND("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k, comma = 1, j + len(key), None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner_x = expand_round(sql[j + len(key):comma])
        digits = sql[comma + 1:k - 1].strip()
        out.append(sql[i:j])
        out.append(f"CAST(ROUND(CAST({inner_x} AS DECIMAL(38,9)), {digits}) AS DOUBLE)")
        i = k


def sx(expr: str):
    """A Spark SQL expression with the same half-up decimal rounding as the oracle."""
    return F.expr(expand_round(expr))
