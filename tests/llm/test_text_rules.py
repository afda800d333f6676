"""Quality rules, license scans, language ID and decontamination."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from reportkit.llm.decontaminate import decontaminate, leaks
from reportkit.llm.langid import codewords, fit, identify, keep_identified
from reportkit.llm.license_scan import WORD, license_scan
from reportkit.llm.line_crf import _lanes, describe, learn, quality, viterbi

DATA = "/root/testdata/sf0.01"     # its 399 labels; the smallest table has 11 rows of low quality

SPACE = r"[^\x20\x09-\x0D]+"


def lower(t):
    return (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def base_counts(text):
    t = text or ""
    w = re.findall(SPACE, t)
    c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = {i + k for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(SPACE, line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep)


def test_base_counts_match_plain_counting():
    rng = random.Random(2)
    texts = ["", "a", "a\n\na\n a\na", "x " * 30, "é𝄞 #|\n" * 5, "\n\n", "tail\x0bend\x1c"]
    texts += ["".join(rng.choice("ab \n#é") for _ in range(rng.randint(0, 300))) for _ in range(60)]
    d = describe([t.encode() for t in texts])
    got = list(zip(d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words))
    assert got == [base_counts(t) for t in texts]


def test_viterbi_and_learning_against_enumeration():
    rng = np.random.default_rng(1)
    step = rng.normal(size=(2, 2))
    n = [1, 4, 7, 3]
    line_text = np.repeat(np.arange(4), n)
    score = rng.normal(size=len(line_text))
    got = viterbi(score, step, *_lanes(line_text))
    at = 0
    for m in n:
        def value(bits):
            y = [bits >> i & 1 for i in range(m)]
            return sum(score[at + i] * y[i] for i in range(m)) + sum(step[a, b] for a, b in zip(y, y[1:]))
        best = max(range(1 << m), key=value)
        assert list(got[at:at + m]) == [best >> i & 1 for i in range(m)]
        at += m
    x = np.stack((np.ones(400), rng.normal(size=400)), axis=1)
    y = (x[:, 1] > 0).astype(int)
    crf = learn(x, np.repeat(np.arange(80), 5), y)
    label = viterbi(x @ crf.emit, crf.step, *_lanes(np.repeat(np.arange(80), 5)))
    assert (label == y).mean() > 0.95


def test_quality_on_the_labelled_table(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality(docs, labels).collect()}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts)
    for d, t in texts.items():
        r, want = got[d], base_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    good = [got[d] for d in marks if marks[d] == 1 and d in got and not got[d].base_failed]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    bad = [got[d] for d in marks if marks[d] == 0 and d in got]
    assert sum(r.kept for r in bad) <= 0.3 * len(bad)


def test_quality_without_labels_nulls_and_empty(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(1, None), (2, ""), (None, "w " * 5), (3, " ".join(f"w{i}" for i in range(40))), (3, "a\nb"), (4, "%%% " * 30)]
    got = quality(docs_of(rows, kept=5, content="c"), labels).collect()
    assert sorted((r.doc_id or 0, r.base_failed, r.kept) for r in got) == [
        (0, True, False), (1, True, False), (2, True, False), (3, False, True), (3, True, False), (4, True, False)]
    assert quality(docs_of(rows).limit(0), labels).count() == 0


def test_license_places_and_labels(docs_of):
    rows = [(1, "Released under the MIT License. Released UNDER the mit-license!"), (2, None), (3, ""), (4, "mit license under the"),
            (5, "This work is licensed under the GNU General Public License, version 3."), (6, "cc by nc cc BY nc"),
            (7, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0."), (8, "under the"), (8, "ÀMIT under the mit license")]
    df = docs_of(rows, words="w", spots=1, base=True)
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 3))
                  for r in license_scan(df).collect()), key=str)
    assert got == sorted([
        (1, 10, 2, 1, 6, "mit", "mit", 1.0), (2, 0, 0, None, None, "", "", 0.0), (3, 0, 0, None, None, "", "", 0.0),
        (4, 4, 0, None, None, "", "", 0.0), (5, 12, 0, None, None, "", "gpl-3", 1.0), (6, 6, 2, 0, 3, "cc-by-nc", "cc-by-nc", 0.429),
        (7, 15, 2, 2, 10, "apache-2,cc-by-nc", "apache-2,cc-by-nc", 1.0), (8, 2, 0, None, None, "", "", 0.0),
        (8, 5, 1, 1, 1, "mit", "mit", 0.8)], key=str)
    assert license_scan(df.limit(0)).count() == 0


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = identify(docs).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and 0.1 < len(held) / len(got) < 0.3
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_codewords_are_apart():
    for n in (2, 3, 4, 9, 40):
        c = codewords(n).astype(int)
        assert c.shape[0] == n and len({tuple(r) for r in c}) == n
        assert all(abs(col.sum()) < n for col in c.T)
    assert codewords(1).shape == (1, 0)


def test_language_edge_cases(spark, docs_of):
    rows = [(i, "der die das und nicht " * 5, "de") for i in range(30)] + [(100 + i, "the and of this with " * 5, "en") for i in range(30)]
    rows += [(200, None, "en"), (201, "", "en"), (202, "123 %% ...", None), (203, "the of and", None), (None, "die und", "de"), (203, "the of and", None)]
    df = docs_of(rows, lang_pred="x", score=3, ambiguous=True)
    got = [(r.doc_id, r.lang_pred, r.score) for r in identify(df).collect()]
    by = {d: p for d, p, _ in got}
    assert by[200] == by[201] == by[202] == "und" and by[203] == "en" and by[None] == "de" and len(got) == len(rows)
    kept = keep_identified(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()}.isdisjoint({200, 201, 202})
    assert kept.count() == len(rows) - 3
    unlabelled = docs_of([(1, "abc", None)])
    assert [r.lang_pred for r in identify(unlabelled).collect()] == ["und"] and identify(df.limit(0)).count() == 0


def brute_leaks(docs, items):
    out = {}
    for d, t in docs:
        w = re.findall(WORD, lower(t))
        for i, s in items:
            it = re.findall(WORD, lower(s))
            n, best = min(len(it), 24), 0
            if len(it) < 8:
                continue
            for shift in range(-len(it), len(w)):
                eq = [0 <= shift + k < len(w) and w[shift + k] == it[k] for k in range(len(it))]
                best = max(best, max(sum(eq[s:s + n]) / n for s in range(len(it) - n + 1)))
            if best >= 0.8:
                out[d, i] = round(best, 6)
    return out


def test_leaks_with_substitutions_match_brute_force(spark, docs_of):
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(200)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(5, 60)))) for i in range(12)]
    docs = []
    for d in range(60):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 80))]
        if d % 2:
            it = rng.choice(items)[1].split()
            for k in rng.sample(range(len(it)), int(rng.choice([0, 0.1, 0.2, 0.5]) * len(it))):
                it[k] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = it
        docs.append((d, " ".join(w).upper() if d % 5 == 0 else ", ".join(w)))
    docs += [(90, None), (91, "")]
    bench = docs_of(items, "item_id long, text string")
    df = docs_of(docs, _row=0, found="f", seed=1)
    got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in leaks(df, bench).collect()}
    want = brute_leaks(docs, items)
    assert set(got) <= set(want) and len(got) >= 0.98 * len(want) and all(want[k] == v for k, v in got.items())
    kept = decontaminate(df, bench)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in got}
    assert leaks(df, bench.limit(0)).count() == 0 and leaks(df.limit(0), bench).count() == 0


def test_repeated_documents_and_null_ids_leak_each(docs_of):
    text = " ".join(f"q{i}" for i in range(30))
    bench = docs_of([(1, text), (None, text), (2, None)], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.item_id or 0) for r in leaks(docs_of([(5, text), (5, text), (None, "a " + text)]), bench).collect())
    assert got == [(0, 0), (0, 1), (5, 0), (5, 0), (5, 1), (5, 1)]
