"""Bucket-pointer refinement against plain sorting of strings."""

import random

import numpy as np
import pytest

from reportkit.llm import suffix_dedup as S


@pytest.mark.parametrize("depth", [3, 7, 8, 20, 100])
@pytest.mark.parametrize("letters", ["a", "ab", "abc\x00\xff"])
def test_pointers_order_strings_as_sorting_does(depth, letters):
    rng = random.Random(depth * 7 + len(letters))
    for _ in range(12):
        base = "".join(rng.choices(letters, k=250))
        segments = []
        for _ in range(rng.randint(1, 6)):
            at = rng.randrange(200)
            segments.append((base[at:at + rng.randint(0, 160)] + rng.choice(["", rng.choice(letters) * rng.randint(0, 120)])).encode("latin-1"))
        sizes = np.array([len(x) for x in segments], np.int64)
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(segments), np.uint8)
        pos, pointer = S.bucket_pointers(data, starts, sizes, depth)
        want = [int(s) + i for s, n in zip(starts, sizes) for i in range(max(0, int(n) - depth + 1))]
        assert pos.tolist() == want
        raw = data.tobytes()
        strings = [raw[p:p + depth] for p in want]
        rank = {x: i for i, x in enumerate(sorted(set(strings)))}
        got = {p: i for i, p in enumerate(sorted(set(pointer.tolist())))}
        assert [got[p] for p in pointer.tolist()] == [rank[x] for x in strings]


def test_waves_do_not_change_the_order(monkeypatch):
    rng = random.Random(1)
    raw = bytes(rng.choices(b"ab", k=3000)) * 3
    sizes = np.array([4000, 5000], np.int64)
    args = np.frombuffer(raw, np.uint8), np.cumsum(sizes) - sizes, sizes, 100
    results = []
    for waves in (1, 3, 64):
        monkeypatch.setattr(S, "WAVES", waves)
        results.append(S.bucket_pointers(*args)[1].tolist())
    assert results[0] == results[1] == results[2]


def test_a_pointer_refined_before_saves_rounds(monkeypatch):
    """Runs of one letter: depths add up, so the number of sorts grows with the logarithm of the depth."""
    calls = []
    real = np.argsort
    monkeypatch.setattr(S.np, "argsort", lambda *a, **k: calls.append(1) or real(*a, **k))
    data = np.frombuffer(b"a" * 5000, np.uint8)
    S.bucket_pointers(data, np.array([0]), np.array([5000]), 100)
    assert len(calls) <= 10
