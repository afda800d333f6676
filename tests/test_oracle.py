"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from reportkit.plans import ORACLE, QUERIES
from reportkit.plans.common import TABLES

SF = "/root/testdata/sf0.001"




def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return f"{round(v, 4):.4f}"
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    want = sorted(tuple(_norm(dict(zip(ocols, r))[c]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_delivery_time_quantiles_match_nearest_rank(spark, con):
    import math as m
    from reportkit.plans.q_support import delivery_quantiles, delivery_times
    got = {r.o_orderpriority: (r.lines, r.p50_days, r.p90_days) for r in delivery_quantiles(delivery_times(spark, SF)).collect()}
    rows = con.execute("""SELECT o.o_orderpriority, date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE))
                          FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""").fetchall()
    by = {}
    for p, v in rows:
        by.setdefault(p, []).append(v)
    for p, vals in by.items():
        vals.sort()
        def rank(q):  # smallest value with at least q of the values at or below it
            return vals[max(0, m.ceil(q * len(vals)) - 1)]
        assert got[p] == (len(vals), rank(0.5), rank(0.9))


def test_registry_publish_and_checks(spark):
    from reportkit import registry
    views = registry.publish_all(spark, SF, prefix="rk_")
    assert "rk_sales_over_time" in views
    assert spark.sql("SELECT COUNT(*) AS n FROM rk_sales_over_time").first().n > 0
    res = registry.run_checks(spark, SF, sample=2)
    assert res["check_sales_equation"]["passed"] and res["check_vouchers_balance"]["passed"]
    assert all(len(v["sample"]) <= 2 for v in res.values())
