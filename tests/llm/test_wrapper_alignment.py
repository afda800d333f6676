"""Alignment of streams of any length, and places read back from the wrapper."""

import json
import random

import pytest

from reportkit.llm import wrappers as W


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


@pytest.mark.parametrize("bits", [1 << 28, 40])
def test_alignment_loses_no_match(monkeypatch, bits):
    monkeypatch.setattr(W, "TABLE_BITS", bits)
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.choice("abcd#") for _ in range(rng.randint(0, 40))] for _ in range(2))
        pairs = W._common(a, b)
        assert len(pairs) == longest(a, b) and all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))


def test_long_middles_are_aligned():
    rng = random.Random(5)
    one = [f"t{i}" for i in range(3000)]
    other = [t for t in one if rng.random() < 0.9]
    other = ["x", *other, "y"]      # no equal ends, nine million token pairs
    merged, place = W.align([(t, False) for t in one], [(t, False) for t in other])
    assert len(merged) == len(one) + 2 and [merged[i][0] for i in place] == other
    again = W.places([t for t, _ in merged], one)
    assert [merged[i][0] for i in again] == one


def test_places_are_those_of_the_wrapper():
    wrapper = "a # /a b # /b c # /c".split()
    assert W.places(wrapper, "a # /a z c # /c".split()) == [0, 1, 2, -1, 6, 7, 8]


@pytest.mark.parametrize("fan", [2, 16])
def test_every_layout_of_a_host_has_its_slots(docs_of, fan):
    rng = random.Random(7)
    rows = [(i, "http://h.com/", "".join(f"<{t}>x{i}</{t}>" for t in rng.choices(["p", "h2", "pre", "section", "dl"], k=rng.randint(1, 12)))) for i in range(60)]
    hosts = W.infer(docs_of(rows, "page_id long, url string, html string"), fan).collect()
    assert [(r.host, r.pages) for r in hosts] == [("h.com", 60)]
    wrapper = [t for t, _ in json.loads(hosts[0].wrapper)]
    for _, _, page in rows:
        folded = W._stream(page)[0]
        place = W.places(wrapper, folded)
        assert [wrapper[i] for i in place] == folded and place == sorted(set(place))
