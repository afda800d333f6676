"""Importance resampling against plain counting."""

import hashlib
import math
import re
import zlib

import pytest

from reportkit.llm import resample as rs


def plain(rows, target, max_n=1, buckets=10_000, percent=10, min_words=20, seed="2024"):
    def grams(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        out = [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(g.encode()) % buckets for g in out]

    s, t = [0] * buckets, [0] * buckets
    for _, text in rows:
        for b in grams(text)[1]:
            s[b] += 1
    for text in target:
        for b in grams(text)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        n_words, bs = grams(text)
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, n_words, len(bs), weight, score])
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {}
    for i, r in enumerate(fit[:percent * len(fit) // 100]):
        ranks.setdefault((r[0], r[2], r[4]), []).append(i + 1)
    return out, ranks


TARGET = ["alpha beta gamma delta", "Beta GAMMA; epsilon 7", None, ""]


def corpus():
    rows = [(i, " ".join(f"w{(i * k) % 13}" if k % 3 else "beta Gamma" for k in range(i % 40))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, " ... !!"), (None, "alpha beta " * 15), (503, "É été Beta x" * 30)]
    rows += [(7000, "beta " * 25)] * 4                  # one row four times
    return rows


@pytest.mark.parametrize("max_n", [1, 2, 3])
def test_weights_scores_and_ranks_match_plain_counting(spark, docs_of, monkeypatch, max_n):
    monkeypatch.setattr(rs, "PIECE", 200)               # many pieces, texts longer than a piece
    rows = corpus()
    docs = docs_of(rows, rank=5, score=1, n_words="x", _row=3)
    target = spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")
    got = rs.resample(docs, target, max_n=max_n, buckets=97, percent=30, min_words=10).collect()
    want, ranks = plain(rows, TARGET, max_n, 97, 30, 10)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got), key=key) == sorted(map(tuple, want), key=key)
    drawn = {}
    for r in got:
        if r["rank"] is not None:
            drawn.setdefault((r.doc_id, r.n_features, r.score), []).append(r["rank"])
    assert {k: sorted(v) for k, v in drawn.items()} == ranks


def test_pieces_cover_every_row_once(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(rs, "PIECE", 10)
    texts = pa.array(["a" * 25, "b", None, "", "c" * 9, "d" * 11, "e"])
    parts = list(rs.pieces(texts))
    assert [x for p in parts for x in p.to_pylist()] == texts.to_pylist()
    assert all(len(p) == 1 or sum(len(x or "") for x in p.to_pylist()) <= 10 for p in parts)


def test_ties_take_the_smaller_id_and_the_cut_splits_them(spark):
    rows = [(i, i, 20, 1, 5 if i < 30 else 9) for i in range(40)] + [(99, None, 20, 1, 5), (100, 7, 19, 1, 50)]
    df = spark.createDataFrame(rows, "_row long, doc_id long, n_words long, n_features long, score long")
    got = {(r._row): r["rank"] for r in rs.draw(df, 50, 20).collect()}
    assert len(got) == 42 and got[100] is None and got[99] is None
    assert [got[i] for i in range(30, 40)] == list(range(1, 11))
    assert [got[i] for i in range(30)] == [*range(11, 21), *[None] * 20]


def test_empty_tables(spark, docs_of):
    empty = docs_of([])
    target = spark.createDataFrame([(1, "beta")], "item_id long, text string")
    assert rs.resample(empty, target).collect() == []
    got = rs.resample(docs_of([(1, "beta")]), target.limit(0)).collect()
    assert [(r.doc_id, r.n_features, r["rank"]) for r in got] == [(1, 1, None)]


@pytest.mark.parametrize("texts", [["Alpha b c d", "a X y", "b k L m"], ["é a b", "a é", "ü k l m n"], ["a b", None, "B c"]])
def test_words_of_a_slice_are_those_of_a_copy(texts):
    import pyarrow as pa
    whole = pa.array(texts)
    for at in range(3):
        for n in range(1, 4 - at):
            words, grams = rs.gram_buckets(whole.slice(at, n))
            want, want_grams = rs.gram_buckets(pa.array(texts[at:at + n], pa.string()))
            assert words.tolist() == want.tolist()
            assert [[x.tolist() for x in g] for g in grams] == [[x.tolist() for x in g] for g in want_grams]


def test_texts_without_nulls_in_several_pieces(spark, docs_of, monkeypatch):
    monkeypatch.setattr(rs, "PIECE", 200)
    rows = [(i, f"Beta w{i % 7} " * (10 + i % 30)) for i in range(60)]
    target = spark.createDataFrame([(1, "beta w3")], "item_id long, text string")
    got = rs.resample(docs_of(rows), target).collect()
    want, _ = plain(rows, ["beta w3"])
    assert sorted((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == sorted(map(tuple, want))
