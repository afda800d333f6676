"""Substring and suffix-array dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from reportkit.llm import runs as R
from reportkit.llm.fm_index import FMIndex, matching_intervals
from reportkit.llm.substring_dedup import substring_dedup
from reportkit.llm.suffix_dedup import bucket_pointers, remove_repeats, suffix_dedup


def words_brute(rows, width):
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    seen = Counter(tuple(w[i:i + width]) for _, w in texts for i in range(len(w) - width + 1))
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def bytes_brute(rows, length):
    seen, out = set(), []
    for d, t in rows:                          # rows in order of doc_id
        t = (t or "").encode()
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            s = t[i:i + length]
            if s in seen:
                gone[i:i + length] = [True] * length
            seen.add(s)
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False] + gone[:-1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = ["the", "of", "a", "é", "zwei", "𝄞x"] + [f"w{i}" for i in range(40)]
    passage = [rng.choice(vocab) for _ in range(50)]
    rows = []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 120))]
        if i % 3 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = passage
        if i % 7 == 0 and rows and rows[-1][1]:
            w = rows[-1][1].split()
            if i % 2:
                w[rng.randrange(len(w))] = "edit"
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(w)))
    rows += [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "it " * 400), (n + 4, "ab" * 300), (n + 5, "x")]
    return rows


@pytest.mark.parametrize("hot", [50_000, 2])
def test_word_windows_match_brute_force(docs_of, hot):
    rows = corpus(1)
    got = sorted(tuple(r) for r in substring_dedup(docs_of(rows), hot_runs=hot).collect())
    assert got == sorted(words_brute(rows, 35))


@pytest.mark.parametrize("hot", [50_000, 2])
def test_byte_strings_match_brute_force(docs_of, hot):
    rows = corpus(2)
    got = sorted(tuple(r) for r in suffix_dedup(docs_of(rows), hot_runs=hot).collect())
    assert got == sorted(bytes_brute(rows, 100))


def test_repeated_rows_null_ids_and_empty_tables(docs_of):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (5, text), (None, text), (7, "short")]
    got = sorted((r.doc_id is None, r.doc_id, r.n_removed) for r in substring_dedup(docs_of(rows)).collect())
    assert got == [(False, 5, 60), (False, 5, 60), (False, 7, 0), (True, None, 60)]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in suffix_dedup(docs_of(rows)).collect()))
    assert got == [(False, 5, len(text)), (False, 5, len(text)), (False, 7, 0), (True, 0, 0)]   # null sorts first, so it stays
    empty = docs_of([(1, "x")]).limit(0)
    assert substring_dedup(empty).count() == 0 and suffix_dedup(empty).count() == 0


def test_remove_repeats_keeps_columns_and_cut_characters(docs_of):
    shared = "".join(chr(0x400 + i) for i in range(70))
    rows = [(1, "\u00e9" + shared), (2, "head \u0169" + shared + " tail"), (3, None)]     # both first letters end in byte A9
    df = docs_of(rows, _row=9, spans="s", n_removed=1)
    out = remove_repeats(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == rows[0][1] and got[2].text == "head  tail" and got[3].text is None
    assert got[2]._row == 9 and got[2].spans == "s" and got[2].n_removed == 1


def test_runs_of_equal_windows_share_a_key():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**60, 200).astype(np.uint64)
    b = np.concatenate((rng.integers(0, 2**60, 17).astype(np.uint64), a[40:110], a[:3]))
    both = np.concatenate((a, b))
    text, start, n, key, content, own = R.find_runs(both, np.array([0, 200, 200 + len(b)]), 35, 12)
    of = {(t, s + k): v for t, s, m, v in zip(text, start, n, key) for k in range(m)}
    assert sum(n) == 166 + len(b) - 34
    assert all(of[0, 40 + k] == of[1, 17 + k] for k in range(36))


def test_bucket_pointers_are_string_classes():
    rng = random.Random(4)
    data = bytes(rng.choice(b"ab") for _ in range(300))
    pos, pointer = bucket_pointers(np.frombuffer(data, np.uint8), np.array([0, 150]), np.array([150, 150]), 20)
    strings = [data[p:p + 20] for p in pos]
    assert [p for p in pos] == [*range(131), *range(150, 281)]
    for i in range(0, len(strings), 7):
        for j in range(len(strings)):
            assert (strings[i] == strings[j]) == (pointer[i] == pointer[j])
            assert (strings[i] < strings[j]) == (pointer[i] < pointer[j])


def test_fm_index_counts_and_matching_statistics():
    rng = np.random.default_rng(3)
    segs = [rng.integers(1, 4, 60) for _ in range(5)]
    text = np.concatenate([np.append(s, 0) for s in segs])
    index = FMIndex(text, 4, 60)
    for _ in range(50):
        s = segs[rng.integers(5)]
        i, m = rng.integers(0, 50), rng.integers(1, 10)
        lo, hi = np.array([0]), np.array([len(text)])
        for c in s[i:i + m][::-1]:
            lo, hi = index.extend(np.array([c]), lo, hi)
        want = sum((x[k:k + m] == s[i:i + m]).all() for x in segs for k in range(61 - m) if len(x[k:k + m]) == len(s[i:i + m]))
        assert hi[0] - lo[0] == want
    starts, sizes = np.arange(5) * 61, np.full(5, 60)
    doc, left, end = matching_intervals(index, text, starts, sizes, 6)
    covered = {(d, k) for d, a, b in zip(doc, left, end) for k in range(a, b - 5)}
    windows = Counter(tuple(s[k:k + 6]) for s in segs for k in range(55))
    assert covered == {(d, k) for d, s in enumerate(segs) for k in range(55) if windows[tuple(s[k:k + 6])] > 1}
