"""S1-S5 on the driver tables and hand-made rows."""

from pyspark.sql import functions as F

from reportkit.sources import cross_settings, publish, read_source, seed, union_sources, with_settings

SF = "/root/testdata/sf0.001"


def test_read_union_publish_seed_settings(spark, tmp_path):
    r = read_source(spark, SF, "region")
    assert spark.sql("SELECT COUNT(*) AS n FROM region").first().n == r.count()
    u = union_sources({"eu": r.limit(2), "us": r.limit(3).withColumn("extra", F.lit(1))}, tag="account")
    assert sorted(x.account for x in u.select("account").distinct().collect()) == ["eu", "us"]
    assert "extra" in u.columns
    t = publish(r, "regions_table", where=F.col("r_regionkey") < 2, mode="table", path=str(tmp_path / "regions"))
    assert t.count() == 2 and spark.sql("SELECT COUNT(*) AS n FROM regions_table").first().n == 2
    s = seed(spark, [("EU", 1)], "code string, n int")
    assert s.first().code == "EU"
    w = with_settings(r, inactivity_minutes=30).select("inactivity_minutes").distinct().collect()
    assert [x.inactivity_minutes for x in w] == [30]
    c = cross_settings(r, r.agg(F.max("r_regionkey").alias("max_key")))
    assert c.select("max_key").distinct().count() == 1


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from reportkit.sources import bucketed
    li = read_source(spark, SF, "lineitem", view=False)
    o = read_source(spark, SF, "orders", view=False)
    bl = bucketed(li, "li_b", ["l_orderkey"], 4, str(tmp_path / "li"))
    bo = bucketed(o.withColumnRenamed("o_orderkey", "l_orderkey"), "o_b", ["l_orderkey"], 4, str(tmp_path / "o"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = bl.join(bo, "l_orderkey")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and j.count() == li.join(o.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
