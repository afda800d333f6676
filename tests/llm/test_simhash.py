import random

import numpy as np
import pytest
import xxhash

from reportkit.llm.components import connected_components
from reportkit.llm.simhash import fingerprint, keep_one, near_links, simhash_groups


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = low.encode().split()
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_groups(ids, fps, bits=3):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return [least[find(i)] for i in range(len(ids))]


def test_fingerprints_and_components(docs_of):
    rng = random.Random(5)
    vocab = [f"Wörd{i}" for i in range(300)]
    rows = []
    for i in range(80):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        if i % 3 == 1 and rows[-1][1]:
            w = rows[-1][1].split()
            w[0] = "changed"
        rows.append((1000 - i, " ".join(w)))
    rows += [(2, None), (3, ""), (4, "  "), (9, "one"), (8, "one two"), (1, rows[0][1].upper())]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_groups(docs_of(rows)).collect()}
    ids = [d for d, _ in rows]
    fps = [brute_fingerprint(t) for _, t in rows]
    assert [int(got[d][0], 16) for d in ids] == fps
    assert [got[d][1] for d in ids] == brute_groups(ids, fps)
    assert got[3][0] == "0" * 16 and got[4][1] == got[3][1]


@pytest.mark.parametrize("hot", [2048, 3])
def test_every_link_up_to_three_bits_is_found(spark, hot):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, 6).astype(np.uint64)
    fps = set(map(int, base))
    for b in base:
        for _ in range(25):
            x = int(b)
            for k in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(k)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    roots = {r.u: r.root for r in connected_components(near_links(df, 3, hot)).collect()}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    assert [roots.get(f, f) for f in signed] == brute_groups(signed, fps)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7)]
    got = {r.u: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 1 for i in range(2, 201)) and all(got[i] == 1000 for i in range(1001, 1200))


def test_repeated_rows_nulls_and_clashing_columns(docs_of):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (3, "A b c D"), (None, "zz"), (None, "zz")]
    df = docs_of(rows, _row=1, fp="x", component_id=0)
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in simhash_groups(df).collect())
    assert got == [(0, 0), (0, 0), (0, 3), (3, 3), (5, 3), (5, 3)]
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "zz"), (3, "A b c D")]
    assert simhash_groups(df.limit(0)).count() == 0 and fingerprint(b"") == 0


@pytest.mark.parametrize("first", [0, 48])
@pytest.mark.parametrize("hot", [40, 4])
def test_dense_groups_are_split_until_they_are_small(spark, first, hot):
    """Fingerprints that differ in one 16-bit part only: the second split leaves them together, the third does not."""
    rng = np.random.default_rng(first + hot)
    base = int(rng.integers(0, 2**63))
    fps = sorted({base ^ (int(x) << first) for x in rng.integers(0, 2**16, 500)})
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    links = near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 3, hot)
    roots = {r.u: r.root for r in connected_components(links).collect()}
    assert [roots.get(f, f) for f in signed] == brute_groups(signed, fps)
