"""Incremental publishing (S3) and one-pass audits."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from reportkit import registry
from reportkit.operators import checks as q
from reportkit.sources.published import published, refresh

SCHEMA = "id int, day date, amount int, gen int"


def period():
    return F.date_format("day", "yyyy-MM")


def build(rows):
    return rows.where("amount > 0").groupBy(period().alias("period")).agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))


def files(path):
    return {os.path.join(r, f): os.path.getmtime(os.path.join(r, f)) for r, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def rows_of(df):
    return {r.period: (r.amount, r.n) for r in df.collect()}


def test_only_changed_periods_are_written_and_the_result_is_a_rebuild(spark, tmp_path):
    path = str(tmp_path / "report")
    rows = [(1, date(2024, 1, 5), 10, 1), (2, date(2024, 2, 5), 20, 1), (3, None, 5, 1), (4, date(2007, 1, 1), 1, 1)]
    src = spark.createDataFrame(rows, SCHEMA)
    assert refresh(spark, src, "gen", period(), build, path, name="rep") == ["2007-01", "2024-01", "2024-02", "none"]
    assert rows_of(spark.table("rep")) == {"2024-01": (10, 1), "2024-02": (20, 1), None: (5, 1), "2007-01": (1, 1)}
    before = files(path)
    assert refresh(spark, src, "gen", period(), build, path) == [] and files(path) == before          # no news: nothing written
    late = spark.createDataFrame(rows + [(5, date(2024, 1, 6), 7, 2), (6, date(2024, 3, 1), 1, 2), (7, date(2024, 2, 1), 9, None)], SCHEMA)
    assert refresh(spark, late, "gen", period(), build, path, name="rep") == ["2024-01", "2024-03"]
    assert rows_of(spark.table("rep")) == rows_of(build(late).where("period IS NULL OR period <> '2024-02'")) | {"2024-02": (20, 1)}
    assert all(files(path)[f] == t for f, t in before.items())                                   # old files untouched


def test_a_rebuilt_period_without_rows_disappears(spark, tmp_path):
    path = str(tmp_path / "report")
    one = spark.createDataFrame([(1, date(2024, 1, 5), 10, 1), (2, date(2024, 2, 5), 20, 1)], SCHEMA)
    refresh(spark, one, "gen", period(), build, path)
    gone = spark.createDataFrame([(1, date(2024, 1, 5), -10, 2), (2, date(2024, 2, 5), 20, 1)], SCHEMA)
    assert refresh(spark, gone, "gen", period(), build, path) == ["2024-01"]
    assert rows_of(published(spark, path)) == {"2024-02": (20, 1)}


def test_a_run_that_died_before_the_switch_is_not_seen_and_is_written_over(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "report")
    one = spark.createDataFrame([(1, date(2024, 1, 5), 10, 1)], SCHEMA)
    refresh(spark, one, "gen", period(), build, path)
    two = spark.createDataFrame([(1, date(2024, 1, 5), 10, 1), (2, date(2024, 1, 6), 5, 2)], SCHEMA)
    real, calls = type(spark).createDataFrame, []

    def dies(self, data, *a, **k):
        if data and isinstance(data[0], tuple) and len(data[0]) == 3 and data[0][0] == "2024-01":
            calls.append(1)
            raise RuntimeError("lost")
        return real(self, data, *a, **k)

    monkeypatch.setattr(type(spark), "createDataFrame", dies)
    with pytest.raises(RuntimeError):
        refresh(spark, two, "gen", period(), build, path)
    assert calls and rows_of(published(spark, path)) == {"2024-01": (10, 1)}
    monkeypatch.undo()
    assert refresh(spark, two, "gen", period(), build, path) == ["2024-01"]
    assert rows_of(published(spark, path)) == {"2024-01": (15, 2)}


def test_an_empty_source_publishes_an_empty_report(spark, tmp_path):
    path = str(tmp_path / "report")
    with pytest.raises(ValueError):
        published(spark, path)
    empty = spark.createDataFrame([], SCHEMA)
    assert refresh(spark, empty, "gen", period(), build, path) == []
    assert published(spark, path).columns == ["period", "amount", "n"] and published(spark, path).count() == 0


def test_audit_counts_all_checks_from_one_scan(spark, tmp_path):
    rows = [(1, 1, 5), (1, 1, -5), (1, 2, None), (None, 2, 3), (None, 2, 4), (7, 7, 0)]
    spark.createDataFrame(rows, "a int, b int, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = q.audit(df, {"positive": F.col("v") > 0, "small": F.col("v") < 100}, {"ab": ["a", "b"], "b": ["b"], "abv": ["a", "b", "v"]})
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.check: (r.violations, r.rows) for r in out.collect()} == {
        "positive": (3, 6), "small": (1, 6), "ab": (2, 6), "b": (2, 6), "abv": (0, 6)}
    assert {r.check: r.violations for r in q.audit(df, {"positive": F.col("v") > 0}).collect()} == {"positive": 3}
    none = {r.check: r.violations for r in q.audit(df.limit(0), {"positive": F.col("v") > 0}).collect()}
    assert none in ({"positive": 0}, {})


def test_audit_deals_rows_and_keys_to_as_many_tasks_as_told(spark):
    hot = spark.range(3000).select((F.col("id") % 2).cast("int").alias("a"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("b"),
                                   (F.col("id") - 5).cast("double").alias("v"))
    out = q.audit(hot, {"positive": F.col("v") > 0}, {"ab": ["a", "b"], "b": ["b"], "a": ["a"]}, tasks=37)
    assert out._jdf.queryExecution().executedPlan().toString().count(" 37), REPARTITION_BY_NUM") == 2
    assert {r.check: (r.violations, r.rows) for r in out.collect()} == {
        "positive": (6, 3000), "ab": (2, 3000), "b": (1, 3000), "a": (2, 3000)}


def test_watched_counts_while_the_report_is_written(spark, tmp_path):
    df = spark.range(100).select((F.col("id") - 10).alias("v"))
    out, seen = q.watched(df, {"positive": F.col("v") > 0})
    out.write.parquet(str(tmp_path / "w"))
    assert seen.get == {"rows": 100, "positive": 11}


def test_registered_audits(spark):
    got = registry.run_audits(spark, "/root/testdata/sf0.001")
    assert got["event_unique"] == 0 and got["line_not_returned"] > 0 and len(got) == 11
