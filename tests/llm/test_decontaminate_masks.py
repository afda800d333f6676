"""Every leak is found: masks by enumeration, results against brute force without exceptions."""

import itertools
import random
import re

import pytest

from reportkit.llm.decontaminate import OVERLAP, leaks, masks_for
from reportkit.llm.license_scan import WORD


def missed(n, masks, changes):
    """Ways of changing ``changes`` of ``n`` words that touch every window of every mask."""
    windows = [int(m, 2) << at for m in masks for at in range(n - len(m) + 1)]
    return sum(all(sum(1 << i for i in c) & w for w in windows) for c in itertools.combinations(range(n), changes))


@pytest.mark.parametrize("n", range(1, OVERLAP + 1))
def test_every_pattern_of_changes_is_hit(n):
    changes = max(c for c in range(n) if (n - c) / n >= 0.8)
    assert missed(n, masks_for(n), changes) == 0
    changes = max(c for c in range(n) if (n - c) / n >= 0.6)
    assert missed(n, masks_for(n, similarity=0.6), changes) == 0


def brute(docs, items, overlap=24, similarity=0.8):
    out = {}
    for d, t in docs:
        w = re.findall(WORD, (t or "").lower())
        for i, s in items:
            it = re.findall(WORD, (s or "").lower())
            n = min(len(it), overlap)
            if n:
                best = max(sum(0 <= shift + k < len(w) and w[shift + k] == it[k] for k in range(s, s + n)) / n
                           for shift in range(-len(it), len(w) + 1) for s in range(len(it) - n + 1))
                if best >= similarity:
                    out[d, i] = round(best, 6)
    return out


@pytest.mark.parametrize("how", [{}, {"overlap": 10, "similarity": 0.7}])
def test_leaks_equal_brute_force_at_every_length(docs_of, how):
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(120)]
    items = [(n, " ".join(rng.choice(vocab) for _ in range(n))) for n in [*range(0, 27), 40, 59]] + [(98, None), (99, "短い文章だけ")]
    docs = [(1000, None), (1001, ""), (1002, "前 短い文章だけ 後")]
    for d in range(150):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        it = (items[d % 29][1] or "").split()
        for k in rng.sample(range(len(it)), len(it) // 5):
            it[k] = "changed"
        at = rng.randint(0, len(w))
        w[at:at] = it
        docs.append((d, " ".join(w)))
    # the patterns that two sparse masks missed
    words = items[15][1].split()
    docs += [(2000 + k, " ".join("changed" if i in c else w for i, w in enumerate(words)))
             for k, c in enumerate(itertools.combinations(range(15), 3)) if k % 5 == 0]
    got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in leaks(docs_of(docs), docs_of(items, "item_id long, text string"), **how).collect()}
    assert got == brute(docs, items, **how)
