"""D11 rules on a change log."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from reportkit.operators import changes as ch
from reportkit.operators import commerce as cm
from reportkit.operators import windows as wn

T = datetime(2024, 3, 1, 23, 59, 0)


def test_edits_join_the_sale_up_to_ninety_seconds(spark):
    rows = [(1, 0, "order"), (1, 90, "ORDER_EDIT"), (1, 91, "ORDER_EDIT"), (1, 30, "RETURN"), (1, -5, "ORDER_EDIT"),
            (2, 10, "ORDER_EDIT"), (3, 0, "ORDER"), (3, 300, "ORDER"), (3, 200, "ORDER_EDIT"), (None, 0, "NOTE")]
    df = spark.createDataFrame([(o, T + timedelta(seconds=s), k, s) for o, s, k in rows], "o int, t timestamp, k string, s int")
    got = {(r.o, r.s, r.k.upper()): (r.row_type, r.is_checkout_edit, r.is_later_edit, r.report_date)
           for r in ch.fold_edits(df, "o", "t", "k").collect()}
    d1, d2 = date(2024, 3, 1), date(2024, 3, 2)
    assert got[1, 0, "ORDER"] == ("SALE", False, False, d1)
    assert got[1, 90, "ORDER_EDIT"] == ("SALE", True, False, d1)        # past midnight, still the sale's day
    assert got[1, 91, "ORDER_EDIT"] == ("SALE", False, True, d2)
    assert got[1, -5, "ORDER_EDIT"] == ("SALE", False, True, d1)
    assert got[1, 30, "RETURN"] == ("RETURN", False, False, d1)
    assert got[2, 10, "ORDER_EDIT"] == ("SALE", False, True, d1)        # an order without creation
    assert got[3, 200, "ORDER_EDIT"][1] is False and got[None, 0, "NOTE"][0] is None


def test_refunds_report_against_the_top_order(spark):
    rows = [(1, None), (2, 1), (3, 2), (4, 3), (5, 99), (6, 7), (7, 6), (8, 6), (9, 9)]
    got = {r.o: (r.report_order_id, r.levels) for r in ch.report_orders(spark.createDataFrame(rows, "o long, p long"), "o", "p").collect()}
    assert got == {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (1, 3), 5: (99, 1), 6: (6, 0), 7: (7, 0), 8: (8, 0), 9: (9, 0)}


def test_a_refund_goes_only_if_all_its_lines_were_declined(spark):
    df = spark.createDataFrame([("a", True), ("a", True), ("b", True), ("b", False), ("c", None), ("d", True), ("d", None)], "r string, x boolean")
    assert sorted(r.r for r in cm.drop_declined_refunds(df, "r", "x").collect()) == ["b", "b", "c", "d", "d"]


def _fold(changes):
    out, o, state = {}, 0, 0
    for i, (_, ordered, cancelled) in enumerate(changes):
        o += ordered or 0
        new = min(state + (cancelled or 0), o)
        out[i], state = new - state, new
    return out


def test_cancellations_are_the_fold_also_for_a_hot_order(spark):
    rng = random.Random(8)
    rows = []
    for order in [*range(20), "hot"]:
        n = 2000 if order == "hot" else rng.randrange(1, 12)
        t = sorted(rng.randrange(20 * 86400) for _ in range(n))
        for i, s in enumerate(t):
            rows.append((str(order), s, i, rng.choice([None, 0, 3, 8, -2]), rng.choice([None, 0, 2, 9])))
    df = spark.createDataFrame([(o, datetime(2024, 1, 1) + timedelta(seconds=s), i, a, c) for o, s, i, a, c in rows],
                               "o string, t timestamp, i int, a long, c long").repartition(5)
    got = ch.cap_over_time(df, "o", ["t", "i"], F.col("a"), F.col("c"), F.to_date("t")).collect()
    by = {}
    for o, s, i, a, c in rows:
        by.setdefault(o, []).append((i, a, c))
    want = {(o, i): x for o, v in by.items() for i, x in _fold(v).items()}
    assert {(r.o, r.i): r.cancelled_capped for r in got} == want


def test_running_min_in_two_levels(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([("a" if i % 3 else None, i, rng.choice([None, rng.randrange(1000)])) for i in range(500)], "k string, i int, v int")
    from pyspark.sql import Window
    w = Window.partitionBy("k").orderBy("i")
    one = df.withColumns({"x": F.min("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), "y": F.min("v").over(w.rowsBetween(Window.unboundedPreceding, -1))})
    two = wn.seq_running_min(df, "k", ["i"], "v", "x", F.floor(F.col("i") / 20), before_out="y")
    assert sorted(map(tuple, one.select("i", "x", "y").collect())) == sorted(map(tuple, two.select("i", "x", "y").collect()))
