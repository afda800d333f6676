"""The pipeline's stages in order, each against what it must keep."""

import random

import corpus_pipeline as C
from reportkit.llm.queries import ORACLE, QUERIES


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    assert [n for n, _ in C.STAGES] == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "source_mixing"]


def test_stages_take_effect(spark, docs_of, tmp_path):
    rng = random.Random(12)
    vocab = {"en": [f"the{c}{d}" for c in "abcdef" for d in "rstlmn"], "de": [f"üng{c}{d}" for c in "abcdef" for d in "rstlmn"]}

    def text(lang, n=60):
        return " ".join(rng.choice(vocab[lang]) for _ in range(n))

    rows = [(i, text(k), k, f"s{i % 3}") for i, k in enumerate(["en", "de"] * 60)]
    item, passage = text("en", 30), text("de", 40)
    rows += [(500, "12 34 %%", None, "s1"), (501, rows[0][1], "en", "s1"), (502, rows[1][1] + " ", "de", "s2"),
             (503, text("en", 20) + " " + item, "en", "s1"), (504, text("de") + " " + passage, "de", "s0"), (505, passage + " " + text("de"), "de", "s0"),
             (506, None, None, None)]
    df = docs_of(rows)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "sf" / "benchmark.parquet"))
    df.write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    seen = df
    for name, stage in C.STAGES:
        seen = C.written(stage(spark, seen, str(tmp_path / "sf")))
        got = {r.doc_id: r.text for r in seen.collect()}
        if name != "source_mixing":
            assert seen.columns == df.columns
        if name == "language_id":
            assert set(got) == {r[0] for r in rows} - {500, 506}
        if name == "simhash_near_dedup":
            assert set(got) == {r[0] for r in rows} - {500, 506, 501, 502}
        if name == "suffix_array_dedup":
            assert len(got) == len(rows) - 4 and passage in got[504] and passage not in got[505]
            assert all(r.n_chars == len(r.text) for r in seen.collect())
        if name == "benchmark_decontamination":
            assert 503 not in got and len(got) == len(rows) - 5
    assert got and set(got) <= {r[0] for r in rows}
    rerun = {r.doc_id for r in C.run(spark, str(tmp_path / "sf")).collect()}
    assert rerun == set(got)


def test_empty_table(spark, docs_of, tmp_path):
    docs_of([(1, "x")]).limit(0).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    docs_of([(1, "x")], "item_id long, text string").write.parquet(str(tmp_path / "sf" / "benchmark.parquet"))
    assert C.run(spark, str(tmp_path / "sf")).count() == 0


def test_odd_rows_pass_through_all_stages(spark, docs_of):
    import random
    from corpus_pipeline import STAGES
    from reportkit.llm.common import written
    rng = random.Random(2)
    words = {"en": "the of and to in is that for it was", "fr": "le la de et les des une pour dans est", "de": "der die und das den von ist mit ein zu"}

    def text(lang, n):
        return " ".join(rng.choice(words[lang].split()) + str(rng.randrange(1000)) for _ in range(n))

    rows = [(i, text(k, 60), k, None if i % 7 == 0 else "s") for i, k in enumerate(list(words) * 30)]
    rows += [(500, None, "en"), (501, "", None), (502, "123 456", "en"), (None, text("en", 70)), (600, text("fr", 30_000), "fr"), rows[3], rows[3]]
    docs = docs_of(rows, _row=1, key="k", fp=2, found=True, lang_pred="x", spans="y", item_id=3)
    names, sf = docs.columns, "/root/testdata/sf0.001"
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf))
        if name != STAGES[-1][0]:
            assert docs.columns == names, name
        got = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        if name == "language_id":
            assert not {500, 501, 502} & {d for d, _ in got} and len(got) == len(rows) - 3 and None in {d for d, _ in got}
        if name == "simhash_near_dedup":
            assert sorted(d for d, _ in got if d == rows[3][0]) == [rows[3][0]] and {600, None} <= {d for d, _ in got}
    empty = docs_of([], mix_x=1)
    for _, stage in STAGES:
        empty = written(stage(spark, empty, sf))
        assert empty.count() == 0
