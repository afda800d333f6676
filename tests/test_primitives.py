"""Primitive operators and column builders on hand-made edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from reportkit.functions import aggregates as A
from reportkit.functions import columns as C
from reportkit.operators import aggs, arrays, joins, sets, windows

D = dt.date


def test_json_and_regex_helpers(spark):
    df = spark.createDataFrame([('[{"plain_text": "Hello "}, {"plain_text": "world"}]', '{"id": 1}'),
                                ("not json", '{"ID": 2}'), ("[]", None)], "parts string, obj string")
    r = df.select(C.json_concat_text("parts", "$[*].plain_text").alias("t"), C.json_array_len("parts").alias("n"),
                  C.json_any("obj", ["$.id", "$.ID"]).alias("id")).collect()
    assert [(x.t, x.n, x.id) for x in r] == [("Hello world", 2, "1"), (None, None, "2"), ("", 0, None)]


def test_date_helpers(spark):
    df = spark.createDataFrame([("2024-03-05",), ("05/03/2024",), ("garbage",)], "s string")
    got = [r.d for r in df.select(C.parse_date_any("s", ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("d")).collect()]
    assert got == [D(2024, 3, 5), D(2024, 3, 5), None]
    r = spark.range(1).select(
        C.from_epoch(F.lit(1_700_000_000_123), "ms").alias("ms"),
        C.from_epoch(F.lit(17_000_000_001_234), "ms", finer=10).alias("tick"),
        C.week_start(F.lit(D(2024, 3, 7)), 2).alias("mon"),
        C.fiscal_year_start(F.lit(D(2024, 3, 7)), 7).alias("fy"),
        C.snapshot_date(F.lit(D(2024, 2, 1)), "2024-02-10").alias("snap"),
        C.least_strict(F.lit(1), F.lit(None).cast("int")).alias("ls")).first()
    assert r.ms.year == 2023 and r.tick == r.ms.replace(microsecond=123000)
    assert r.mon == D(2024, 3, 4) and r.fy == D(2023, 7, 1) and r.snap == D(2024, 2, 10) and r.ls is None


def test_aggregate_builders(spark):
    df = spark.createDataFrame([("g", 1, None, 2.0, 0.0), ("g", 2, "b", 4.0, 0.0), ("g", 3, "a", 6.0, 0.0),
                                ("h", 1, "x", 1.0, 1.0)], "k string, o int, v string, x double, w double")
    r = {x.k: x for x in df.groupBy("k").agg(
        A.pick_first("v", "o").alias("first"), A.pick_last("v", "o").alias("last"),
        A.string_list("v", ",", by="o").alias("lst"), A.unique_or_null("v").alias("uniq"),
        A.weighted_avg("x", "w").alias("wavg"), A.count_distinct_when("v", F.col("o") > 1).alias("cd"),
        A.mode_of("x").alias("mode")).collect()}
    assert (r["g"].first, r["g"].last, r["g"].lst, r["g"].uniq, r["g"].wavg, r["g"].cd) == ("b", "a", "b,a", None, None, 2)
    assert (r["h"].uniq, r["h"].wavg, r["h"].mode) == ("x", 1.0, 1.0)


def test_pivot_ratios_merge_and_null_safe_join(spark):
    long = spark.createDataFrame([(1, "clicks", 5.0), (1, "impr", 50.0), (2, "impr", 0.0)], "id int, m string, v double")
    p = aggs.with_ratios(aggs.pivot_kv(long, "id", "m", "v", {"clicks": "clicks", "impr": "impr"}),
                         {"ctr": ("clicks", "impr")}).orderBy("id").collect()
    assert [(x.clicks, x.impr, x.ctr) for x in p] == [(5.0, 50.0, 0.1), (None, 0.0, None)]
    a = spark.createDataFrame([("x", 1.0)], "k string, a double")
    b = spark.createDataFrame([("y", 2.0)], "k string, b double")
    c = spark.createDataFrame([("x", 3.0), (None, 4.0)], "k string, c double")
    m = {r.k: (r.a, r.b, r.c) for r in joins.merge_full([a, b, c], "k").collect()}
    assert m == {"x": (1.0, 0.0, 3.0), "y": (0.0, 2.0, 0.0), None: (0.0, 0.0, 4.0)}
    n1 = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    n2 = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert sorted((r.v, r.w) for r in joins.join_ns(n1, n2, "k").collect()) == [(1, 10), (2, 20)]


def test_sets_and_arrays(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, sales double")
    b = spark.createDataFrame([(1, 5)], "k int, units int")
    u = sets.union_events({"sale": a, "ship": b}, fill={"sales": 0.0}).orderBy("row_type").collect()
    assert [(r.row_type, r.sales, r.units) for r in u] == [("sale", 2.0, None), ("ship", 0.0, 5)]
    assert sorted(r.k for r in sets.key_union([a, b.withColumn("k", F.lit(2))], ["k"]).collect()) == [1, 2]
    j = spark.createDataFrame([(1, '[{"sku": "a"}, {"sku": "b"}]'), (2, "[]"), (3, "{bad")], "id int, items string")
    ex = arrays.explode_json(j, "items", "struct<sku:string>").select("id", "pos", "item.sku").collect()
    assert [(r.id, r.pos, r.sku) for r in ex] == [(1, 0, "a"), (1, 1, "b")]
    keep = arrays.explode_json(j, "items", "struct<sku:string>", keep_empty=True)
    assert keep.where("id = 2").count() == 1
    arr = spark.createDataFrame([(1, ["x", "y"], ["y", None]), (2, None, ["z"])], "id int, to array<string>, cc array<string>")
    got = sorted((r.id, r.value) for r in arrays.explode_arrays(arr, ["to", "cc"], distinct=True).collect()
                 if r.value is not None)
    assert got == [(1, "x"), (1, "y"), (2, "z")]


def test_window_operators(spark):
    rows = [("e", D(2024, 1, 1), 10.0), ("e", D(2024, 1, 2), 12.0), ("e", D(2024, 1, 4), 11.0), ("e", D(2024, 3, 1), 20.0)]
    df = spark.createDataFrame(rows, "e string, d date, v double")
    dc = {str(r.d): r.v_change for r in windows.daily_change(df, "e", "d", "v").collect()}
    assert dc == {"2024-01-01": None, "2024-01-02": 2.0, "2024-01-04": None, "2024-03-01": None}
    tr = {str(r.d): r.t for r in windows.trailing_agg(df, "e", "d", "v", 3, "sum", include_current=False, out="t").collect()}
    assert tr == {"2024-01-01": None, "2024-01-02": 10.0, "2024-01-04": 22.0, "2024-03-01": None}  # days d-3..d-1
    mb = {str(r.d): r.m for r in windows.max_before(df, "e", "d", "v", out="m").collect()}
    assert mb["2024-01-04"] == 12.0 and mb["2024-01-01"] is None
    months = spark.createDataFrame([("e", D(2024, 1, 1), 10.0), ("e", D(2024, 3, 1), 20.0)], "e string, m date, v double")
    pc = {str(r.m): (r.prev_v, r.v_growth) for r in windows.period_change(months, "e", "m", ["v"], calendar="month").collect()}
    assert pc == {"2024-01-01": (None, None), "2024-03-01": (None, None)}  # a gap month gives NULL
    pr = {str(r.m): r.prev_v for r in windows.period_change(months, "e", "m", ["v"]).collect()}
    assert pr["2024-03-01"] == 10.0  # previous row
    bc = {str(r.d): r.backcast_total for r in windows.back_cast(
        df.withColumn("total", F.lit(100.0)), "e", "d", "v", "total").collect()}
    assert bc["2024-03-01"] == 100.0 and bc["2024-01-01"] == 100.0 - 12.0 - 11.0 - 20.0


def test_trailing_join_emits_each_window_day(spark):
    df = spark.createDataFrame([("u", D(2024, 1, 1))], "u string, d date")
    got = sorted(str(r.window_date) for r in joins.trailing_join(df, ["u"], "d", 3).collect())
    assert got == ["2024-01-01", "2024-01-02", "2024-01-03"]


def test_bucketed_generic_windows_equal_plain(spark):
    import random
    random.seed(2)
    rows = [("h" if random.random() < 0.8 else "c", random.randint(0, 999), i, float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, id int, v double")
    b = F.floor(F.col("t") / 100)
    o = ["t", "id"]
    plain = windows.running_total(windows.number_rows(windows.next_(windows.prev(df, "k", o, "v"), "k", o, "v"),
                                                      "k", o, desc=True), "k", o, "v")
    two = windows.running_total(windows.number_rows(windows.next_(windows.prev(df, "k", o, "v", bucket=b), "k", o, "v",
                                                                  bucket=b), "k", o, desc=True, bucket=b), "k", o, "v", bucket=b)
    cols = ["id", "prev_v", "next_v", "row_number", "running_v"]
    assert sorted(tuple(r) for r in plain.select(*cols).collect()) == sorted(tuple(r) for r in two.select(*cols).collect())


def test_scalar_builders(spark):
    r = spark.range(1).select(
        C.local_date(F.lit(T := dt.datetime(2024, 1, 1, 23, 30)), "Europe/Copenhagen").alias("cph"),
        C.local_date(F.lit(T), offset_seconds=F.lit(-3600 * 24)).alias("off"),
        C.scale_unit(F.lit(1234), 100).alias("major"),
        C.signed(F.lit(5.0), F.lit(True)).alias("neg"),
        C.duration(F.lit(T), F.lit(None).cast("timestamp"), "HOUR", as_of="2024-01-02 02:30:00").alias("open_h"),
        C.make_key(F.lit("a"), F.lit(1)).alias("key"),
        C.parse_hhmm(F.lit(" 7:05 ")).alias("ok"), C.parse_hhmm(F.lit("7:65")).alias("bad"),
        C.clean_text(F.lit("  ")).alias("blank"), C.in_array(F.lit("x"), F.lit(None).cast("array<string>")).alias("ina"),
        C.ratio(F.lit(1), F.lit(0)).alias("r0"), C.ratio(F.lit(1), F.lit(3), scale=100, digits=2).alias("pct")).first()
    assert str(r.cph) == "2024-01-02" and str(r.off) == "2023-12-31" and r.major == 12.34 and r.neg == -5.0
    assert r.open_h == 3 and r.key == "a:1" and r.ok == 425 and r.bad == 7 * 60 + 65 and r.blank is None
    assert r.ina is False and r.r0 is None and r.pct == 33.33


def test_rollup_facts_and_kinds_keep_null_keys(spark):
    a = spark.createDataFrame([(None, 1.0), ("k", 2.0)], "k string, v double")
    b = spark.createDataFrame([(None, 5.0)], "k string, w double")
    r = {x.k: (x.sv, x.sw) for x in aggs.rollup_facts(None, {"a": (a, {"sv": F.sum("v")}), "b": (b, {"sw": F.sum("w")})},
                                                        "k").collect()}
    assert r == {None: (1.0, 5.0), "k": (2.0, 0.0)}
    ev = spark.createDataFrame([(None, "x", 1), (None, "y", 2), ("k", "x", 3)], "k string, kind string, u int")
    g = {x.k: (x.nx, x.uy) for x in aggs.rollup_kinds(ev, "k", "kind", {"x": {"nx": ("count", None)},
                                                                         "y": {"uy": ("count_distinct", "u")}}).collect()}
    assert g == {None: (1, 1), "k": (1, 0)}
