"""Named reports: the registry of driver-table bindings, published as temp views, and a
data-test runner.

``publish_all`` exposes every report under its stable name (S3) so consumers can
query them with SQL; ``run_checks`` executes every ``check_*`` report (each returns
offending rows, empty = pass) and reports pass / fail with a bounded sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .plans import ORACLE, QUERIES


def names() -> list[str]:
    return sorted(QUERIES)


def get(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return QUERIES[name](spark, sf_dir)


def oracle(name: str) -> str | None:
    return ORACLE.get(name)


def publish_all(spark: SparkSession, sf_dir: str, prefix: str = "") -> list[str]:
    """Register every report as a temp view. Views are lazy, but reports that checkpoint a step (chains, summaries, sorted
    numbering, published tables) run that step here."""
    from .sources import publish
    out = []
    for n in names():
        publish(QUERIES[n](spark, sf_dir), prefix + n)
        out.append(prefix + n)
    return out


def run_checks(spark: SparkSession, sf_dir: str, sample: int = 5) -> dict:
    """Run every data-quality check; returns ``{name: {"passed": bool, "sample": [...]}}``.

    Only ``sample`` offending rows per check ever reach the driver.
    """
    res = {}
    for n in names():
        if not n.startswith("check_"):
            continue
        rows = QUERIES[n](spark, sf_dir).limit(sample).collect()
        res[n] = {"passed": not rows, "sample": [r.asDict() for r in rows]}
    return res


def run_audits(spark: SparkSession, sf_dir: str) -> dict:
    """Row-level and key checks of the audited reports, each report read once; ``{check: violations}`` (0 = pass)."""
    from .plans.q_audit import audits
    return {r.check: r.violations for r in audits(spark, sf_dir).collect()}      # one row per check
