"""Ticket times: ratings sent at one moment."""

import pytest
from pyspark.sql import functions as F

from reportkit.operators import support as sp


def _latest(spark, rows, **kw):
    t = spark.createDataFrame([(1, "2024-01-01 00:00:00", None)], "id int, created string, solved string").withColumns(
        {"created": F.to_timestamp("created"), "solved": F.to_timestamp("solved")})
    m = spark.createDataFrame([(1, *r) for r in rows], "id int, at string, line int, rating double").withColumn("at", F.to_timestamp("at"))
    out = sp.ticket_times(t, m.repartition(3), "id", "created", "at", F.lit(False), "solved", rating="rating", **kw)
    return out.first().latest_rating


def test_tied_messages_take_the_larger_rating_whatever_the_row_order(spark):
    rows = [("2024-01-02 00:00:00", 1, 0.02), ("2024-01-02 00:00:00", 1, 0.07), ("2024-01-02 00:00:00", 1, None), ("2024-01-01 12:00:00", 9, 0.9)]
    assert _latest(spark, rows) == _latest(spark, rows[::-1]) == 0.07


def test_a_tiebreak_column_comes_before_the_rating(spark):
    rows = [("2024-01-02 00:00:00", 2, 0.02), ("2024-01-02 00:00:00", 1, 0.07)]
    assert _latest(spark, rows, tiebreak=["line"]) == 0.02


def test_exact_response_stats_equal_plain_percentiles(spark):
    rows = [(i % 3 if i % 7 else None, float(i * i % 23) if i % 11 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "p int, v double")
    out = sp.response_stats(df, [], "p", "v", 10, exact=True)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2       # equal values counted before percentiles
    for r in out.collect():
        v = sorted(x for p, x in rows if p == r.p and x is not None)
        at = lambda q: (lambda k: v[int(k)] + (k - int(k)) * (v[min(int(k) + 1, len(v) - 1)] - v[int(k)]))((len(v) - 1) * q)
        assert (r.responses, r.within_sla) == (len(v), sum(x <= 10 for x in v))
        assert [r.mean_value, r.median_value, r.p90_value] == pytest.approx([sum(v) / len(v), at(0.5), at(0.9)], abs=1e-4)
