"""Line labels that switch inside a text, and odd inputs of the quality rules."""

import random

import numpy as np

from reportkit.llm import line_crf as C

GOOD = "The committee met in the old hall and talked about the plan for a long while."
JUNK = "BUY!! NOW$$$ ### CHEAP*** DEAL%%% ||| 999 $$$ &&& !!!"


def corpus(n=240):
    rng, rows, marks = random.Random(3), [], []
    for i in range(n):
        good = i % 2
        own, other = (GOOD, JUNK) if good else (JUNK, GOOD)
        lines = [own] * rng.randint(6, 10) + [other] * rng.randint(0, 2)
        if i % 3 == 0:
            rng.shuffle(lines)
        rows.append((i, "\n".join(f"{line} {rng.randrange(10 ** 6)}" for line in lines)))
        marks.append((i, good, 0))
    return rows, marks


def test_decoded_lines_switch_inside_mixed_texts(spark, docs_of):
    rows, marks = corpus()
    rows += [(1000, "\n".join([GOOD + " a", GOOD + " b", JUNK + " c", JUNK + " d", GOOD + " e", GOOD + " f"]))]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in C.quality(docs_of(rows), labels).collect()}
    assert got[1000].content == [True, True, False, False, True, True] and 0.5 < got[1000].content_share < 1
    mixed = [i for i, t in rows if i < 1000 and GOOD in t and JUNK in t]
    assert mixed and sum(0 < got[i].content_share < 1 for i in mixed) > 0.9 * len(mixed)
    assert all((got[i].content_share >= 0.5) == bool(i % 2) for i in range(240))


def test_line_labels_keep_one_line_of_every_text(spark):
    x = np.array([[1.0, 0], [1, 1], [1, 1], [1, 1], [1, 0], [1, 0]])
    y = C.line_labels(x, np.array([0, 0, 1, 1, 2, 2]), np.array([1, 1, 1, 1, 0, 0]))
    assert set(y[:2]) >= {1} and 1 in y[2:4] and 0 in y[4:]
    assert (C.line_labels(x, np.array([0, 0, 1, 1, 2, 2]), np.ones(6, int)) == 1).all()       # one quality only


def test_clashing_columns_and_long_texts(spark, docs_of, monkeypatch):
    monkeypatch.setattr(C, "PIECE", 200)
    rows, marks = corpus(40)
    rows += [(500, (GOOD + "\n") * 3000), (501, None), (None, GOOD * 3)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    plain = {r.doc_id: r.asDict() for r in C.quality(docs_of(rows), labels).collect()}
    clash = docs_of(rows, quality=1, _quality=0, kept=False, content=3, n_words="x", order=1)
    assert {r.doc_id: r.asDict() for r in C.quality(clash, labels).collect()} == plain
    assert plain[500]["n_words"] == 16 * 3000 and len(plain[500]["content"]) == 3000 and plain[501]["base_failed"]


def test_ties_in_decoding_are_content():
    step = np.zeros((2, 2))
    first, n = C._lanes(np.array([0, 0, 0, 1]))
    assert C.viterbi(np.zeros(4), step, first, n).tolist() == [1, 1, 1, 1]
