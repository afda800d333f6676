"""Q1-Q15: data-quality checks. Each returns the offending rows; empty = pass.

All are plain filters, aggregates, anti-joins or lag windows over the checked
report, so they run distributed like the report itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import tasks_for

# Rows of a report per task of ``audit``: few columns each.
AUDIT_ROWS_A_TASK = 250_000


def _l(x):
    return [x] if isinstance(x, str) else list(x)


def check_unique(df: DataFrame, keys) -> DataFrame:
    """Q1: key combinations that occur more than once (F5: a HAVING-style filter)."""
    return df.groupBy(*_l(keys)).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def check_reconciles(a: DataFrame, b: DataFrame, on, measures: list[str], tol: float = 0.01) -> DataFrame:
    """Q2: keys where summed measures of two models differ by more than ``tol``."""
    keys = _l(on)
    sa = a.groupBy(*keys).agg(*[F.sum(m).alias(f"a_{m}") for m in measures])
    sb = b.groupBy(*keys).agg(*[F.sum(m).alias(f"b_{m}") for m in measures])
    j = sa.join(sb, keys, "full")
    bad = reduce(lambda x, y: x | y, [
        F.abs(F.coalesce(F.col(f"a_{m}"), F.lit(0.0)) - F.coalesce(F.col(f"b_{m}"), F.lit(0.0))) > tol
        for m in measures])
    return j.where(bad)


def check_identity(df: DataFrame, lhs: Column, rhs: Column, by=None, tol: float = 0.01) -> DataFrame:
    """Q3: rows (or groups) where lhs != rhs beyond ``tol``."""
    if by:
        g = df.groupBy(*_l(by)).agg(F.sum(lhs).alias("lhs"), F.sum(rhs).alias("rhs"))
        return g.where(F.abs(F.col("lhs") - F.col("rhs")) > tol)
    return df.withColumns({"lhs": lhs, "rhs": rhs}).where(F.abs(F.col("lhs") - F.col("rhs")) > tol)


def check_non_negative(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q4."""
    return df.where(reduce(lambda x, y: x | y, [F.col(c) < 0 for c in cols]))


def check_within(df: DataFrame, part: str, whole: str) -> DataFrame:
    """Q5: part must not exceed whole."""
    return df.where(F.col(part) > F.col(whole))


def check_monotonic(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q6: each funnel column must not exceed the previous one (wide form)."""
    return df.where(reduce(lambda x, y: x | y, [F.col(b) > F.col(a) for a, b in zip(cols, cols[1:])]))


def check_monotonic_long(df: DataFrame, part, order: str, c: str) -> DataFrame:
    """Q6 (long form): value must not grow from one step to the next."""
    w = Window.partitionBy(*_l(part)).orderBy(order)
    return df.withColumn("_p", F.lag(c).over(w)).where(F.col(c) > F.col("_p")).drop("_p")


def check_shares(df: DataFrame, by, share: str, tol: float = 0.01) -> DataFrame:
    """Q7: shares within a group must sum to one."""
    return (df.groupBy(*_l(by)).agg(F.sum(share).alias("share_total"))
            .where(F.abs(F.col("share_total") - 1) > tol))


def check_accepted(df: DataFrame, col: str, values: list) -> DataFrame:
    """Q8: every row classified into an accepted value (NULL is a violation)."""
    return df.where(F.col(col).isNull() | ~F.col(col).isin(values))


def check_no_gaps(df: DataFrame, keys, date: str) -> DataFrame:
    """Q9: entities whose dated rows skip a day (count != span)."""
    g = df.groupBy(*_l(keys)).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"),
                                  F.count_distinct(date).alias("n_days"))
    return g.where(F.datediff("last_date", "first_date") + 1 != F.col("n_days"))


def check_parses(df: DataFrame, raw: str, parsed: str) -> DataFrame:
    """Q10: raw text present but parsed value NULL."""
    return df.where(F.col(raw).isNotNull() & (F.trim(F.col(raw)) != "") & F.col(parsed).isNull())


def check_resolves(df: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Q11: references that do not resolve in the dimension (NULL references are fine)."""
    keys = _l(on)
    nonnull = df.where(reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys]))
    return nonnull.join(dim.select(*keys).distinct(), keys, "left_anti")


def check_balances(ledger: DataFrame, by, debit: str = "debit", credit: str = "credit",
                   tol: float = 0.01) -> DataFrame:
    """Q12: double entry must balance per group."""
    g = ledger.groupBy(*_l(by)).agg(F.sum(debit).alias("total_debit"), F.sum(credit).alias("total_credit"))
    return g.where(F.abs(F.col("total_debit") - F.col("total_credit")) > tol)


def check_expr(df: DataFrame, expr: Column) -> DataFrame:
    """Q13: rows where the expectation is not TRUE (NULL counts as a failure)."""
    return df.where(~F.coalesce(expr, F.lit(False)))


def check_single_current(df: DataFrame, key, flag: str) -> DataFrame:
    """Q14: entities with other than exactly one current row."""
    return (df.groupBy(*_l(key)).agg(F.count_if(F.col(flag)).alias("n_current"))
            .where("n_current != 1"))


def check_bridge(df: DataFrame, keys, period: str, opening: str, closing: str, tol: float = 0.01) -> DataFrame:
    """Q15: each period's opening must equal the previous period's closing."""
    w = Window.partitionBy(*_l(keys)).orderBy(period)
    return (df.withColumn("prev_closing", F.lag(closing).over(w))
            .where(F.col("prev_closing").isNotNull() & (F.abs(F.col(opening) - F.col("prev_closing")) > tol)))


def _misses(ok: Column) -> Column:
    return F.count_if(~F.coalesce(ok, F.lit(False)))


def watched(df: DataFrame, rows: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """Row-level checks counted while the report itself is written: ``df`` to write, and the metrics to read afterwards
    (``.get``: violations per name, and ``rows``). No scan of their own. The counts are accumulators: exact, unless a lost
    executor makes Spark run finished tasks again (then too high); ``audit`` counts exactly in every case."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[_misses(ok).alias(name) for name, ok in rows.items()]), seen


def audit(df: DataFrame, rows: dict[str, Column], keys: dict[str, list[str]] | None = None, tasks: int | None = None) -> DataFrame:
    """Q1, Q3-Q6, Q8, Q10, Q13 in one pass over a report: ``(check, violations, rows)``, one row per check.

    ``rows``: name -> condition every row must meet (not TRUE counts as a violation). ``keys``: name -> columns that must
    tell rows apart (violations: key values that occur more than once; NULLs are values). The report is read once: every row
    stands once per key set, the row-level counts travel with the first set. Rows are dealt to ``tasks`` (``tasks_for(df)``
    if not given) in pieces of the report and combined there; only then are a key's counts brought together, so that neither
    a long report nor a key of many rows fills a task.
    """
    names, sets = list(rows), list((keys or {}).items())
    missed = [f"_r{i}" for i in range(len(names))]
    every = list(dict.fromkeys(c for _, cols in sets for c in cols))
    flags = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(every)],
                      *[F.when(F.coalesce(rows[n], F.lit(False)), 0).otherwise(1).alias(m) for n, m in zip(names, missed)])
    if sets:
        n = tasks or tasks_for(df, AUDIT_ROWS_A_TASK)
        place = [f"_k{i}" for i in range(len(every))]
        # a row's piece follows from its partition and its keys, so it is the same if a lost task runs again
        flags = flags.withColumn("_part", F.spark_partition_id())
        flags = flags.withColumn("_piece", F.pmod(F.xxhash64("_part", *place), F.lit(16 * n))).drop("_part").repartition(n, "_piece")
        types = dict(flags.dtypes)
        copies = [F.struct(F.lit(s).alias("_set"), *[F.col(k) if c in cols else F.lit(None).cast(types[k]).alias(k) for k, c in zip(place, every)],
                           *[(F.col(m) if s == 0 else F.lit(0)).alias(m) for m in missed]) for s, (_, cols) in enumerate(sets)]
        flags = flags.select("_piece", F.explode(F.array(*copies)).alias("_c")).select("_piece", "_c.*")
        g = flags.groupBy("_piece", "_set", *place).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(m).alias(m) for m in missed])
        g = g.repartition(n, "_set", *place).groupBy("_set", *place).agg(F.sum("_n").alias("_n"), *[F.sum(m).alias(m) for m in missed])
        g = g.groupBy("_set").agg(F.count_if(F.col("_n") > 1).alias("_twice"), F.sum("_n").alias("_rows"), *[F.sum(m).alias(m) for m in missed])
    else:
        g = flags.agg(F.count(F.lit(1)).alias("_rows"), *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in missed])
        g = g.withColumns({"_set": F.lit(0), "_twice": F.lit(0).cast("long")})
    found = [(s, name, "_twice") for s, (name, _) in enumerate(sets)] + [(0, name, m) for name, m in zip(names, missed)]
    out = F.array(*[F.struct(F.lit(s).alias("_of"), F.lit(name).alias("check"), F.col(c).alias("violations"), F.col("_rows").alias("rows"))
                    for s, name, c in found])
    return g.select("_set", F.explode(out).alias("_o")).where("_set = _o._of").select("_o.check", "_o.violations", "_o.rows")
