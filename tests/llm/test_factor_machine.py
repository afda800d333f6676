"""The factorisation machine against its plain formula, plain counting and held-out labels."""

import zlib

import numpy as np
import pytest

from reportkit.llm import factor_machine as fm
from reportkit.llm.common import read_table

SF = "/root/testdata/sf0.01"


def test_the_linear_time_score_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(1)
    m = fm.Machine(0.3, rng.normal(size=40), rng.normal(size=(40, 3)))
    doc, place, value = np.array([0, 0, 0, 2, 2]), np.array([1, 7, 39, 0, 5]), rng.normal(size=5)
    got = m.score(doc, place, value, 3)
    for d in range(3):
        at = np.flatnonzero(doc == d)
        z = m.bias + sum(m.w[place[i]] * value[i] for i in at)
        z += sum(m.v[place[i]] @ m.v[place[j]] * value[i] * value[j] for i in at for j in at if i < j)
        assert got[d] == pytest.approx(1 / (1 + np.exp(-z)))


def test_vectors_of_many_texts_are_those_of_each_alone():
    texts = [b"Alpha beta beta\n\nalpha | 7!!\nalpha | 7!!", b"", "é ü é\x0b ö".encode(), b"x" * 500, b" \n ", b"A*** b###"]
    doc, place, value = fm.vectors(texts)
    for i, t in enumerate(texts):
        d, p, v = fm.vectors([t])
        assert (p == place[doc == i]).all() and v == pytest.approx(value[doc == i])
    p, v = place[doc == 0], value[doc == 0]
    words = v[p < 1 << fm.WORD_BITS]
    # alpha x 2, beta x 2, "|" x 2, "7!!" x 2, Alpha x 1
    assert sorted(np.round(words * np.sqrt(17), 6).tolist()) == [1, 2, 2, 2, 2]
    k = 1 << fm.WORD_BITS
    stats = dict(zip(p.tolist(), v.tolist()))
    bars = fm._KINDS.index(b"|")
    assert stats[k + 3 * bars + 1] == pytest.approx(2 / 9) and stats[k + 3 * bars + 2] == pytest.approx(2 / 3)
    assert stats[k + 3 * len(fm._KINDS) + 2] == pytest.approx(1 / 3)        # one of three lines was seen before


def test_learning_needs_the_pairs():
    """Labels that only a product of two places explains (exclusive or)."""
    rng = np.random.default_rng(3)
    x, y = [], []
    for _ in range(1500):
        a, b = rng.integers(0, 2, 2)
        x.append((np.array([10 + a, 20 + b], np.int32), np.ones(2, np.float32)))
        y.append(int(a != b))
    m = fm.fit(x, np.array(y), np.ones(len(y)))
    flat = lambda a, b: m.score(np.zeros(2, int), np.array([10 + a, 20 + b]), np.ones(2), 1)[0]
    assert min(flat(0, 1), flat(1, 0)) > 0.9 and max(flat(0, 0), flat(1, 1)) < 0.1


def test_held_out_rows_are_told_apart(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    rows = fm.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    mark = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in mark]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.predicted == mark[r.doc_id] for r in held) / len(held) > 0.97
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def test_held_out_labels_teach_nothing(spark, docs_of):
    docs = docs_of([(i, f"word{i % 5} and more") for i in range(40)])
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in held], "doc_id long, quality int, toxic int")
    assert {r.score for r in fm.classify(docs, labels).collect()} == {0.5}


def test_odd_rows(spark, docs_of, monkeypatch):
    monkeypatch.setattr(fm, "PIECE", 64)
    rows = [(i, "good plain words here " * 3 if i % 2 else "BAD!! STUFF!! ") for i in range(60)]
    rows += [(100, None), (101, ""), (None, "good plain words here"), (102, "long " * 5000), (7, "good plain words here " * 3)]
    docs = docs_of(rows, quality=1, score=2.0, held_out=True, predicted=9, mark=3)
    labels = spark.createDataFrame([(i, i % 2, None, "x") for i in range(60)] + [(3, 1, 0, "y"), (None, 0, 0, "z"), (5, None, 0, "z")],
                                   "doc_id long, quality int, toxic int, text string")
    got = fm.classify(docs, labels).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "held_out", "score", "predicted"}
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.score)
    assert by[None] and len(by[7]) == 2 and by[7][0] == by[7][1] > 0.7 > by[8][0]
    assert by[100] == by[101]


def test_empty_tables(spark, docs_of):
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert fm.classify(docs_of([]), labels).collect() == []
    assert [r.score for r in fm.classify(docs_of([(1, "a b")]), labels.limit(0)).collect()] == [0.5]
