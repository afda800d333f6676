"""Stored summaries and operators on a global order, against plain counting."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reportkit.operators import sketches as sk
from reportkit.operators import sorting as so
from reportkit.operators import windows as wn
from reportkit.operators.joins import range_join


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# A6

@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_merged_sketches_answer_within_the_stated_bound(spark, kind):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"k{i % 7}", datetime(2024, 1, 1) + timedelta(days=rng.randrange(70)), int(rng.lognormvariate(5, 2)) if i % 11 else None)
            for i in range(20_000)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v long").withColumn("v", F.col("v").cast(kind))
    daily = sk.daily_quantile_sketches(df, ["k"], "ts", "v", k=200)
    ps = {"a": 0.0, "b": 0.5, "c": 0.99, "d": 1.0}
    answers = sk.sketch_quantiles(sk.merge_quantile_sketches(daily, ["k"], F.trunc("day", "month"), kind), ps, kind)
    got = answers.collect()
    for r in got:
        vals = sorted(v for k, t, v in rows if k == r.k and t.date().replace(day=1) == r.period and v is not None)
        assert r.n == len(vals)
        for name, p in ps.items():
            below, upto = sum(v < r[name] for v in vals), sum(v <= r[name] for v in vals)
            e = sk.rank_error(200)
            assert below <= (p + e) * len(vals) and upto >= (p - e) * len(vals) and r[name] in vals
    facts = df.withColumn("period", F.trunc(F.to_date("ts"), "month"))
    bounds = sk.rank_bounds(facts, answers, ["k", "period"], "v", ps, sk.rank_error(200)).collect()
    assert len(bounds) == len(got) and all(r.a_in_bound and r.b_in_bound and r.c_in_bound and r.d_in_bound for r in bounds)
    off = answers.withColumn("b", F.col("c"))
    assert not any(r.b_in_bound for r in sk.rank_bounds(facts, off, ["k", "period"], "v", ps, 0.05).collect() if r.n > 100)


# A3 / D03

def test_dense_ids_are_the_places_of_the_sorted_values(spark):
    vals = [f"u{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals * 2] + [(None,)] * 3, "u string").repartition(7)
    got = {r.u: r.id for r in sk.dense_ids(df, "u").collect()}
    assert got == {v: i for i, v in enumerate(vals)}
    assert sk.dense_ids(df.limit(0), "u").collect() == []


def test_bitmaps_count_users_over_nested_periods_past_one_bucket(spark):
    rng = random.Random(4)
    rows = [(f"t{i % 2}", datetime(2024, 1, 1) + timedelta(days=rng.randrange(120)), rng.randrange(400_000) if i % 3 else 5)
            for i in range(60_000)]
    df = spark.createDataFrame(rows + [("t0", datetime(2024, 1, 1), None)], "t string, ts timestamp, u long")
    daily = sk.daily_bitmaps(df, ["t"], "ts", "u")
    assert daily.agg(F.max("bucket")).first()[0] > 1
    got = {(r.t, r.grain, r.period_start): r.users for r in sk.distinct_over_periods(
        daily, ["t"], {"month": F.trunc("day", "month"), "all": F.lit("2024-01-01")}).collect()}
    want = defaultdict(set)
    for t, ts, u in rows:
        want[t, "month", ts.date().replace(day=1)].add(u)
        want[t, "all", date(2024, 1, 1)].add(u)
    assert got == {k: len(v) for k, v in want.items()}


# A7

def test_most_frequent_breaks_ties_by_the_smallest_value(spark):
    rows = [("a", 3), ("a", 3), ("a", 1), ("a", 1), ("a", None), ("a", None), ("a", None), ("b", None), (None, 7)]
    df = spark.createDataFrame(rows, "k string, v int")
    got = {r.k: (r.v, r.n) for r in sk.most_frequent(df, ["k"], "v", count_out="n").collect()}
    assert got == {"a": (1, 2), "b": (None, 0), None: (7, 1)}
    assert sk.most_frequent(df, [], "v", out="m").collect()[0].m == 1
    assert "collect" not in plan(sk.most_frequent(df, ["k"], "v")).lower() and "mode(" not in plan(sk.most_frequent(df, ["k"], "v"))


@pytest.mark.parametrize("share", [0.02, 0.2])
def test_frequent_items_are_exact_whatever_the_number_of_values(spark, share):
    rng = random.Random(9)
    rows = [(datetime(2024, 1, 1) + timedelta(days=rng.randrange(60)), f"v{int(rng.paretovariate(0.4))}" if i % 3 else "hot") for i in range(30_000)]
    df = spark.createDataFrame(rows + [(datetime(2024, 1, 3), None)], "ts timestamp, v string")
    got = {(r.period, r.v): r.n for r in sk.frequent_items(df, [], "ts", "v", F.trunc("_day", "month"), share).collect()}
    n, tot = Counter((t.date().replace(day=1), v) for t, v in rows), Counter(t.date().replace(day=1) for t, _ in rows)
    assert got == {k: c for k, c in n.items() if c >= share * tot[k[0]]} and len(got) > 1


# W3

def test_ranks_equal_the_window_for_a_hot_part_with_ties_and_nulls(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else rng.choice(["a", None]), rng.choice([None, rng.randrange(50), 7]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "p string, v int, id int").repartition(5)
    for order in (["v"], ["-v"], ["-v", "id"]):
        got = so.rank_over_ranges(df, ["p"], order, "rank", "dense")
        from pyspark.sql import Window
        w = Window.partitionBy("p").orderBy(*so._order(order))
        want = df.withColumns({"rank": F.rank().over(w).cast("long"), "dense": F.dense_rank().over(w).cast("long")})
        assert sorted(map(tuple, got.select("id", "rank", "dense").collect())) == sorted(map(tuple, want.select("id", "rank", "dense").collect()))
    assert "windowspecdefinition(p" not in plan(got) and "Window" in plan(got)
    whole = so.rank_over_ranges(df, [], ["id"], "place")
    assert sorted((r.id, r.place) for r in whole.collect()) == [(i, i + 1) for i in range(3000)]


def test_sums_before_over_many_range_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).select(F.col("id"), (F.col("id") * 7 % 11).alias("w")).repartition(9)
        got = {r.id: r.s for r in so.sums_before(df, ["-id"], {"s": F.col("w")}).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {i: sum(j * 7 % 11 for j in range(i + 1, 1000)) for i in range(1000)}


# J5

def _pairs(points, ranges, closed):
    return sorted((p[0], r[0]) for p in points for r in ranges if p[1] is not None and (r[1] is None or p[1] >= r[1])
                  and (r[2] is None or p[1] < r[2] or (closed == "[]" and p[1] == r[2])))


@pytest.mark.parametrize("closed", ["[)", "[]"])
@pytest.mark.parametrize("width", [1, 4, 1024])
def test_sweep_join_equals_all_pairs(spark, closed, width):
    rng = random.Random(width)
    points = [(i, 50.0 if i % 3 == 0 else rng.choice([None, rng.randrange(100) / 2])) for i in range(300)]      # a third at one point
    ranges = [(i, a, a + rng.choice([0, 0.5, 3, 20, -1])) for i, a in enumerate(rng.randrange(-10, 60) * 1.0 for _ in range(60))]
    ranges += [(100, None, 10.0), (101, 20.0, None), (102, None, None), (103, 50.0, 50.0), (104, 900.0, None), (105, 3.0, 3.0)]
    a = spark.createDataFrame(points, "id int, x double").repartition(4)
    b = spark.createDataFrame(ranges, "r int, lo double, hi double")
    got = so.range_sweep_join(a, b, "x", "lo", "hi", closed, slice_values=width)
    assert sorted((r.id, r.r) for r in got.collect()) == _pairs(points, ranges, closed)
    left = so.range_sweep_join(a, b.where("r < 100 AND r % 9 = 0"), "x", "lo", "hi", closed, "left", width)
    few = [r for r in ranges if r[0] < 100 and r[0] % 9 == 0]
    hit = _pairs(points, few, closed)
    assert sorted((r.id, r.r) for r in left.collect() if r.r is not None) == hit
    assert {r.id for r in left.collect()} == {p[0] for p in points}


def test_sweep_join_of_timestamps_plans_no_nested_loop(spark):
    t0 = datetime(2024, 1, 1)
    a = spark.createDataFrame([(i, t0 + timedelta(minutes=i % 97)) for i in range(500)], "id int, t timestamp")
    b = spark.createDataFrame([(i, t0 + timedelta(minutes=i), t0 + timedelta(minutes=i + 5) if i % 4 else None) for i in range(50)],
                              "r int, f timestamp, u timestamp")
    j = range_join(a, b, None, "t", "f", "u")
    text = plan(j)
    assert "Cartesian" not in text and text.count("BroadcastNestedLoopJoin") <= 1      # the number of points, one row
    assert "SortMergeJoin" in text or "HashJoin" in text
    n = sum(1 for i in range(500) for k in range(50) if k <= i % 97 and (k % 4 == 0 or i % 97 < k + 5))
    assert j.count() == n
    assert range_join(a.limit(0), b, None, "t", "f", "u").count() == 0 and range_join(a, b.limit(0), None, "t", "f", "u").count() == 0


@pytest.mark.parametrize("closed", ["[)", "[]"])
def test_range_totals_equal_summed_pairs(spark, closed):
    rng = random.Random(5)
    points = [(i, 50.0 if i % 3 == 0 else rng.choice([None, rng.randrange(100) / 2])) for i in range(300)]
    ranges = [(i, a, a + rng.choice([0, 0.5, 3, -1])) for i, a in enumerate(rng.randrange(-10, 20) * 1.0 for _ in range(30))]
    tail = [(100, None, 10.0), (101, 40.0, None), (102, 50.0, 50.0), (103, 900.0, None), (None, 3.0, 4.0), (7, 3.0, 4.0)]
    a = spark.createDataFrame(points, "id int, x double").repartition(4)
    for rows in (ranges, ranges + tail, ranges + [(104, None, None)]):
        b = spark.createDataFrame(rows, "r int, lo double, hi double")
        got = so.range_totals(a, b, "x", "lo", "hi", {"n": F.lit(1), "ids": F.col("id")}, closed, unmatched=True)
        inside = lambda x, r: x is not None and (r[1] is None or x >= r[1]) and (r[2] is None or x < r[2] or (closed == "[]" and x == r[2]))
        want = [(*r, len(m), sum(m)) for r in rows for m in [[i for i, x in points if inside(x, r)]] if m]
        none = [i for i, x in points if not any(inside(x, r) for r in rows)]
        want.append((None, None, None, len(none), sum(none)))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_range_totals_make_no_pairs(spark):
    n = 3000                                            # nine million pairs
    a = spark.range(n).select(F.lit(1.0).alias("x"))
    b = spark.range(n).select(F.col("id").alias("r"), F.lit(0.0).alias("lo"), F.lit(2.0).alias("hi"))
    t = so.range_totals(a, b, "x", "lo", "hi", {"n": F.lit(1)})
    assert t.agg(F.sum("n")).head()[0] == n * n
    assert "_slice" not in plan(t)


def test_distinct_after_equals_plain_sets(spark):
    rng = random.Random(6)
    t0 = datetime(2024, 1, 1, 23, 30)
    rows = [(rng.choice([None, *range(9)]), t0 + timedelta(minutes=rng.randrange(120)) if i % 40 else None) for i in range(250)]
    wins = [(i if i < 30 else rng.choice([None, 50, 51]), t0 + timedelta(minutes=rng.randrange(-20, 140))) for i in range(45)] + [(5, None), (60, None)]
    wins.append(wins[7])
    length = F.expr("INTERVAL 10 MINUTES")
    a = spark.createDataFrame(rows, "u int, t timestamp").repartition(4)
    b = spark.createDataFrame(wins, "o int, f timestamp").withColumn("z", F.col("f") + length)
    got = {r.o: r.n for r in so.distinct_after(a, b, "u", "t", "o", "f", "z", length, "n").collect()}
    want = {o: len({u for u, t in rows if u is not None and t is not None
                    and any(f is None or f <= t < f + timedelta(minutes=10) for p, f in wins if p == o)}) for o, _ in wins}
    assert got == want


# W12

def test_trailing_over_days_equals_the_single_window(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else None, date(2024, 1, 1) + timedelta(days=rng.randrange(40)) if i % 50 else None, rng.choice([None, rng.randrange(100)]), i)
            for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, d date, v int, id int")
    for fn in ("sum", "count", "min", "max", "avg"):
        for current in (True, False):
            one = wn.trailing_agg(df, "k", "d", "v", 7, fn, current, "x")
            two = wn.trailing_over_days(df, "k", "d", "v", 7, fn, current, "x")
            assert sorted((r.id, r.x) for r in one.collect() if r.x is not None) == sorted((r.id, r.x) for r in two.collect() if r.x is not None)


def test_trailing_window_equals_the_single_window(spark):
    from pyspark.sql import Window
    rng = random.Random(6)
    rows = [("hot" if i % 3 else None, datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(5000), microseconds=rng.randrange(3)) if i % 60 else None,
             rng.randrange(100), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int, id int")
    for seconds in (1, 60, 10_000):
        for fn in ("sum", "min", "count"):
            w = Window.partitionBy("k").orderBy(F.unix_micros("t")).rangeBetween(-seconds * 1_000_000, 0)
            one = df.withColumn("x", getattr(F, fn)("v").over(w))
            two = wn.trailing_window(df, "k", "t", "v", seconds, fn, "x")
            assert sorted((r.id, r.x) for r in one.collect()) == sorted((r.id, r.x) for r in two.collect())
