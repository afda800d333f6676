"""Edge fixtures for operators whose semantics are easy to get wrong."""

import datetime as dt

from pyspark.sql import functions as F

from reportkit.operators import commerce as cm
from reportkit.operators import ledger as lg
from reportkit.operators import revenue as rv
from reportkit.operators.joins import asof_join, range_join
from reportkit.operators.timegrid import flatten_tree, follow_chain

D = dt.date


def test_allocate_zero_base_splits_evenly(spark):
    lines = spark.createDataFrame([(1, 1, 0.0, 10.0), (1, 2, 0.0, 10.0), (2, 1, 3.0, 8.0), (2, 2, 1.0, 8.0),
                                   (2, 3, -5.0, 8.0)], "o int, l int, w double, amt double")
    got = {(r.o, r.l): round(r.alloc, 6) for r in cm.allocate(lines, "o", "amt", "w", "alloc").collect()}
    assert got == {(1, 1): 5.0, (1, 2): 5.0, (2, 1): 6.0, (2, 2): 2.0, (2, 3): 0.0}


def test_asof_join_newest_before_with_earliest_fallback(spark):
    facts = spark.createDataFrame([("a", D(2024, 1, 1)), ("a", D(2024, 1, 5)), ("a", D(2024, 1, 10)), ("b", D(2024, 1, 1))],
                                  "sku string, d date")
    hist = spark.createDataFrame([("a", D(2024, 1, 3), 1.0), ("a", D(2024, 1, 5), 2.0), ("a", D(2024, 1, 7), 3.0)],
                                 "sku string, eff date, cost double")
    got = {(r.sku, str(r.d)): r.cost for r in asof_join(facts, hist, "sku", "d", "eff", ["cost"]).collect()}
    assert got == {("a", "2024-01-01"): 1.0, ("a", "2024-01-05"): 2.0, ("a", "2024-01-10"): 3.0, ("b", "2024-01-01"): None}


def test_asof_rows_as_points_equal_the_join_back(spark):
    facts = spark.createDataFrame([("a", f"2024-0{m}-10", m * 10 + i) for m in range(1, 8) for i in range(2)] + [("b", "2024-01-01", 1),
                                  ("c", "2024-01-01", 2), (None, "2024-02-01", 3), ("a", None, 4)], "sku string, d string, x int"
                                  ).withColumn("d", F.to_date("d"))
    hist = spark.createDataFrame([("a", "2024-03-11", 1.0), ("a", "2024-05-01", None), ("b", "2024-03-01", 3.0), (None, "2024-01-01", 4.0)],
                                 "sku string, eff string, cost double").withColumn("eff", F.to_date("eff"))
    for fallback, early in (("earliest", 1.0), (None, None)):
        want = {("a", m * 10 + i): early if m < 4 else 1.0 if m < 5 else None for m in range(1, 8) for i in range(2)}
        want |= {("b", 1): 3.0 if fallback else None, ("c", 2): None}
        for points in (False, True):
            r = asof_join(facts, hist, "sku", "d", "eff", ["cost"], fallback, distinct_points=points, tasks=5)
            assert r.columns == ["sku", "d", "x", "cost"]
            got = [(x.sku, x.x, x.cost) for x in r.where("d IS NOT NULL").collect()]
            assert len(got) == len(want) + 1
            assert {(a, b): c for a, b, c in got if a} == want
            assert [c for a, _, c in got if a is None] == [4.0 if points else None]


def test_range_join_half_open_and_open_ended(spark):
    pts = spark.createDataFrame([("a", D(2024, 1, 10)), ("a", D(2024, 2, 1)), ("a", D(2025, 1, 1))], "sku string, d date")
    rng = spark.createDataFrame([("a", D(2024, 1, 1), D(2024, 2, 1), 1.0), ("a", D(2024, 2, 1), None, 2.0)],
                                "sku string, lo date, hi date, c double")
    for bucket in (None, 30):
        got = sorted((str(r.d), r.c) for r in range_join(pts, rng, ["sku"], "d", "lo", "hi", "[)", bucket).collect())
        assert got == [("2024-01-10", 1.0), ("2024-02-01", 2.0), ("2025-01-01", 2.0)]


def test_aging_buckets(spark):
    asof = D(2024, 3, 31)
    rows = [(i, asof - dt.timedelta(days=n), 1.0) for i, n in enumerate([0, 1, 30, 31, 60, 61, 90, 91])]
    rows += [(100, None, 1.0), (101, asof, 0.0)]
    docs = spark.createDataFrame(rows, "id int, due date, amt double")
    got = {r.id: r.aging_bucket for r in lg.aging(docs, None, "due", "amt", "2024-03-31").collect()}
    assert got == {0: "Current", 1: "1-30", 2: "1-30", 3: "31-60", 4: "31-60", 5: "61-90", 6: "61-90", 7: "91 and over",
                   100: "Unknown"}


def test_normalise_recurring_snaps_to_whole_months(spark):
    lines = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 31), 30.0), (D(2024, 1, 1), D(2025, 1, 1), 1200.0),
                                   (D(2024, 1, 1), D(2024, 1, 8), 7.0), (D(2024, 1, 5), D(2024, 1, 5), 1.0)],
                                  "s date, e date, amt double")
    got = sorted((r.service_days, round(r.monthly_amount, 4)) for r in rv.normalise_recurring(lines, "s", "e", "amt").collect())
    assert got == [(7, round(7.0 / (7 / 30.4375), 4)), (30, 30.0), (366, 100.0)]


def test_classify_movement_order(spark):
    rows = [("c", D(2024, m, 1), v) for m, v in [(1, 10.0), (2, 15.0), (3, 5.0), (4, 0.0), (5, 0.0), (6, 7.0)]]
    df = spark.createDataFrame(rows, "k string, month date, mrr double")
    got = [(r.movement_type, r.movement_amount) for r in rv.classify_movement(df, "k").orderBy("month").collect()]
    assert got == [("new", 10.0), ("expansion", 5.0), ("contraction", -10.0), ("churn", -5.0), ("reactivation", 7.0)]


def test_follow_chain_has_no_cap_and_flags_loops(spark):
    rows = [(1, 2), (2, 3), (3, None), (4, 5), (5, 4), (6, 99), (7, 4)] + [(i, i + 1) for i in range(100, 300)] + [(300, None)]
    df = spark.createDataFrame(rows, "id int, nxt int")
    got = {r.id: (r.final_id, r.hops, r.in_loop) for r in follow_chain(df, "id", "nxt").collect()}
    assert got[1] == (3, 2, False) and got[3] == (3, 0, False) and got[6] == (6, 0, False)
    assert got[100] == (300, 200, False) and got[299] == (300, 1, False)
    assert got[4] == got[5] == got[7] == (None, None, True)
    assert follow_chain(df.limit(0), "id", "nxt").count() == 0


def test_flatten_tree_orphan_and_depth(spark):
    rows = [("r", None, "Root"), ("a", "r", "A"), ("b", "a", "B"), ("o", "missing", "Orphan")]
    got = {r.node_id: (r.root_id, r.path, r.depth) for r in flatten_tree(spark.createDataFrame(
        rows, "id string, p string, n string"), "id", "p", "n").collect()}
    assert got["b"] == ("r", "Root > A > B", 3) and got["o"] == ("o", "Orphan", 1)


def test_point_in_time_dedupes_nothing(spark):
    facts = spark.createDataFrame([("a", dt.datetime(2024, 1, 2, 23, 0))], "sku string, ts timestamp")
    hist = spark.createDataFrame([("a", dt.datetime(2024, 1, 2, 22, 0), 5.0)], "sku string, eff timestamp, cost double")
    r = cm.point_in_time(facts, hist, "sku", "ts", "eff", ["cost"]).collect()
    assert [x.cost for x in r] == [5.0]  # effective the same day counts


def test_greatest_strict_null_semantics(spark):
    from reportkit.functions import greatest_strict
    r = spark.range(1).select(greatest_strict(F.lit(1), F.lit(None).cast("int")).alias("g"),
                              greatest_strict(F.lit(1), F.lit(2)).alias("h")).first()
    assert r.g is None and r.h == 2


def test_streaming_keeps_newest_generation(spark, tmp_path):
    from reportkit.streaming import append_generations, latest_generation
    src, out = tmp_path / "src", tmp_path / "out"
    name = f"t{tmp_path.name}"
    spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double").write.parquet(str(src / "f1"))
    append_generations(spark, str(src / "*"), "k string, v double", str(out), name).awaitTermination(120)
    spark.createDataFrame([("a", 5.0)], "k string, v double").write.parquet(str(src / "f2"))
    append_generations(spark, str(src / "*"), "k string, v double", str(out), name).awaitTermination(120)
    got = {r.k: r.v for r in latest_generation(spark, str(out), ["k"]).collect()}
    assert got == {"a": 5.0, "b": 2.0}


def test_two_level_neighbors_match_single_window(spark):
    import random
    from pyspark.sql.window import Window
    from reportkit.operators.windows import seq_neighbors, seq_next_when
    random.seed(3)
    rows = []
    for i in range(400):
        u = "hot" if random.random() < 0.6 else random.choice(["a", "b", None])
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=random.randint(0, 60 * 24 * 5))
        rows.append((u, ts, i, random.choice(["x", "y", "z"])))
    df = spark.createDataFrame(rows, "u string, ts timestamp, id int, v string")
    w = Window.partitionBy("u").orderBy("ts", "id")
    ref = df.select("id", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"),
                    F.min(F.when(F.col("v") == "z", F.col("ts"))).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("nz"))
    got = seq_neighbors(df, "u", ["ts", "id"], ["v"], F.to_date("ts"))
    got = seq_next_when(got, "u", ["ts", "id"], F.col("v") == "z", "ts", "nz", F.to_date("ts"))
    a = sorted((r.id, r.p, r.n, r.nz) for r in ref.collect())
    b = sorted((r.id, r.prev_v, r.next_v, r.nz) for r in got.select("id", "prev_v", "next_v", "nz").collect())
    assert a == b


def test_two_level_numbering_and_running_sum(spark):
    import random
    from pyspark.sql.window import Window
    from reportkit.operators.windows import change_points, seq_number, seq_running_sum
    random.seed(5)
    rows = [("hot" if random.random() < 0.7 else "cold", random.randint(0, 5000), i, float(random.randint(1, 9)),
             random.choice(["a", "b"])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t int, id int, v double, s string")
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = {r.id: (r.rn, r.rs) for r in df.select("id", F.row_number().over(w).alias("rn"),
                                                  F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs")).collect()}
    b = F.floor(F.col("t") / 700)
    got = seq_running_sum(seq_number(df, "k", ["t", "id"], "rn", b), "k", ["t", "id"], "v", "rs", b)
    assert {r.id: (r.rn, r.rs) for r in got.collect()} == ref
    one = {r.id for r in change_points(df, "k", ["t", "id"], "s").collect()}
    two = {r.id for r in change_points(df, "k", ["t", "id"], "s", bucket=b).collect()}
    assert one == two


def test_sales_variants(spark):
    orders = spark.createDataFrame([(1, None), (2, 1), (3, None)], "id int, parent int")
    assert {r.id: r.report_order_id for r in cm.repoint_refunds(orders, "id", "parent").collect()} == {1: 1, 2: 1, 3: 3}
    lines = spark.createDataFrame([("r1", True), ("r1", True), ("r2", True), ("r2", False), ("r3", None)],
                                  "refund string, declined boolean")
    assert sorted({r.refund for r in cm.drop_declined_refunds(lines, "refund", "declined").collect()}) == ["r2", "r3"]
    c = spark.createDataFrame([(5.0, 3.0), (1.0, 3.0)], "cancelled double, ordered double")
    assert [r.cancelled for r in cm.cap_cancelled(c, "cancelled", "ordered").collect()] == [3.0, 1.0]
    n = spark.createDataFrame([("credit", 10.0), ("invoice", 10.0)], "t string, amt double")
    got = {r.t: r.amt for r in cm.sign_credit_notes(n, ["amt"], F.col("t") == "credit").collect()}
    assert got == {"credit": -10.0, "invoice": 10.0}


def test_asof_two_level_matches_brute_force(spark):
    import random
    random.seed(11)
    hist = [("hot" if random.random() < 0.7 else "k2", D(2023, 1, 1) + dt.timedelta(days=random.randint(0, 400)),
             float(i)) for i in range(120)]
    seen = {}
    for k, d, v in hist:  # keep one history row per (key, day)
        seen[(k, d)] = v
    hist = [(k, d, v) for (k, d), v in seen.items()]
    facts = [("hot" if random.random() < 0.7 else random.choice(["k2", "k3"]),
              D(2022, 12, 1) + dt.timedelta(days=random.randint(0, 450))) for _ in range(300)]
    fdf = spark.createDataFrame(facts, "sku string, d date")
    hdf = spark.createDataFrame(hist, "sku string, eff date, cost double")
    got = sorted((r.sku, str(r.d), r.cost) for r in asof_join(fdf, hdf, "sku", "d", "eff", ["cost"]).collect())

    def brute(k, d):
        before = [(e, v) for kk, e, v in hist if kk == k and e <= d]
        if before:
            return max(before)[1]
        after = [(e, v) for kk, e, v in hist if kk == k]
        return min(after)[1] if after else None
    assert got == sorted((k, str(d), brute(k, d)) for k, d in facts)


def test_recommended_conf_sizes_partitions():
    from reportkit.session import recommended_conf
    c = recommended_conf(100 * (1 << 40), 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(recommended_conf(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 16


def test_flatten_tree_deep_and_loop(spark):
    rows = [("a", "b", "A"), ("b", "a", "B"), ("c", "a", "C"), ("r", None, "R"), ("x", "r", "X")]
    rows += [(f"d{i}", f"d{i - 1}" if i else None, str(i)) for i in range(30)]
    got = {r.node_id: (r.root_id, r.depth, r.in_loop, r.path) for r in flatten_tree(
        spark.createDataFrame(rows, "id string, p string, n string"), "id", "p", "n").collect()}
    assert got["a"] == got["b"] == got["c"] == (None, None, True, None)
    assert got["x"] == ("r", 2, False, "R > X")
    assert got["d29"] == ("d0", 30, False, " > ".join(map(str, range(30))))


def test_fused_prev_and_next_when_equals_separate(spark):
    import random
    from reportkit.operators.windows import seq_neighbors, seq_next_when, seq_prev_and_next_when
    random.seed(9)
    rows = [("hot" if random.random() < 0.7 else "c", random.randint(0, 3000), i, random.choice(["r", "s"]))
            for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, id int, d string")
    b = F.floor(F.col("t") / 250)
    sep = seq_next_when(seq_neighbors(df, "k", ["t", "id"], ["d"], b, next_prefix=None), "k", ["t", "id"],
                        F.col("d") == "s", "t", "nxt", b)
    fused = seq_prev_and_next_when(df, "k", ["t", "id"], ["d"], F.col("d") == "s", "t", "nxt", b)
    cols = ["id", "prev_d", "nxt"]
    assert sorted(tuple(r) for r in sep.select(*cols).collect()) == sorted(tuple(r) for r in fused.select(*cols).collect())
