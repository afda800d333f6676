"""JSON text to rows through VARIANT."""

from pyspark.sql import functions as F

from reportkit.operators import operations as op
from reportkit.operators.arrays import explode_json

ROWS = [(1, '{"a": [{"b": [1, "x", null, {"c": 2.5}]}, {"b": []}, {"b": 7}, 5]}'), (2, None), (3, '{bad'), (4, "{}"), (5, '{"a": []}'),
        (6, '{"a": {"k2": "v", "k1": [true]}}'), (7, "[1]"), (8, '{"a": 3}'), (9, "")]


def table(spark):
    return spark.createDataFrame(ROWS, "pos int, t string").withColumns({"value": F.lit("mine"), "key": F.lit("mine too")})


def test_one_level_keeps_unlike_elements_and_the_inputs_own_columns(spark):
    got = explode_json(table(spark).withColumnRenamed("pos", "id"), "t", path="$.a", at="at", key="entry").collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.id, r.pos)):
        assert r.value == "mine" and r.key == "mine too"
        by.setdefault(r.id, []).append((r.pos, r.entry, r.at, r.item.toJson()))
    assert by == {1: [(0, None, "$.a[0]", '{"b":[1,"x",null,{"c":2.5}]}'), (1, None, "$.a[1]", '{"b":[]}'), (2, None, "$.a[2]", '{"b":7}'),
                      (3, None, "$.a[3]", "5")],
                  6: [(0, "k1", "$.a.k1", "[true]"), (1, "k2", "$.a.k2", '"v"')]}


def test_keep_empty_keeps_every_row(spark):
    got = explode_json(table(spark), "t", path="$.a", keep_empty=True, pos=False, out="x")
    n = {r.pos: r["n"] for r in got.groupBy("pos").count().withColumnRenamed("count", "n").collect()}
    assert n == {1: 4, 2: 1, 3: 1, 4: 1, 5: 1, 6: 2, 7: 1, 8: 1, 9: 1}
    assert got.where("pos IN (2, 3, 4, 5, 7, 8, 9) AND x IS NOT NULL").count() == 0


def test_lists_inside_lists(spark):
    d = table(spark).withColumnRenamed("pos", "id").drop("value", "key")
    for path in ("$.a[*].b", "$.a[*].b[*]"):
        got = sorted((r.id, r.pos_1, r.pos_2, r.item, r.at) for r in explode_json(d, "t", "string", path, at="at").collect())
        assert got[0] == (1, 0, 0, "1", "$.a[0].b[0]") and [r[3] for r in got] == ["1", "x", None, '{"c":2.5}']
        assert len(got) == 4 and got[3][4] == "$.a[0].b[3]"
    kept = explode_json(d, "t", "int", "$.a[*].b", keep_empty=True).where("id = 1").collect()
    assert sorted((r.pos_1, r.pos_2 is None, r.item) for r in kept if r.item is not None or r.pos_2 is None) == [
        (0, False, 1), (1, True, None), (2, True, None), (3, True, None)]


def test_where_filters_elements_and_wrong_types_are_null(spark):
    d = spark.createDataFrame([(1, '[{"kind": "person", "id": "7"}, {"kind": "team", "id": 8}, {"kind": "person", "id": {}}]')], "id int, t string")
    ex = explode_json(d, "t", "struct<kind:string,id:int>", where=F.col("item.kind") == "person").collect()
    assert [(r.pos, r.item and r.item.id) for r in sorted(ex, key=lambda r: r.pos)] in ([(0, 7)], [(0, 7), (2, None)])


def test_assignments_from_typed_entries(spark):
    d = spark.createDataFrame([(1, '{"people": [{"kind": "person", "id": 5}, {"kind": "team", "id": 6}, {"kind": "person", "id": 5}, {"kind": "person"}, 9]}'),
                               (2, "nonsense"), (3, None)], "item int, people string")
    got = op.assignments(d, "item", "people", path="$.people", kind="$.kind", kinds=["person"], person="$.id").collect()
    assert [(r.item, r.person) for r in got] == [(1, "5")]


def test_the_plan_explodes_in_one_stage_without_a_shuffle(spark):
    plan = explode_json(table(spark), "t", path="$.a[*].b")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("variant_explode") >= 2 and "Exchange" not in plan and "Join" not in plan
