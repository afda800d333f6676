"""Suffix-array dedup: bytes of a repeated 100-byte string go, its first occurrence stays.

Method: bucket-pointer refinement. The positions of a shard are put into buckets by their first
7 bytes; a bucket's pointer is its place in the suffix array, and its depth the number of bytes its
positions share. Buckets are taken up in order, some at a time (``WAVES``). A bucket's positions are
sorted by the bucket pointers as many bytes on as its depth; the parts get their own pointers at
once and are refined in turn, until a part has one position or a depth of 100 bytes. A pointer
read may have been refined before, by an earlier bucket or by the same one: its whole depth is
then added, so later buckets need few rounds. Neighbours in the order are compared byte by byte
over 100 bytes, so equal strings are equal for certain.

Shards are made by ``repeats``: windows that could be equal share a shard.

Defined cases: null or empty text: 0 bytes, nothing removed, the hash of the empty string;
null doc_id: counts as smaller than any other; rows with one doc_id: in file order; fully
repeated rows: separate documents, the first keeps its bytes; texts under 100 bytes: kept;
empty table: no rows; other columns of the input: ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from . import repeats
from .common import plain_names

LENGTH = 100
GRAM = 24
SHARD = 1 << 19   # bytes indexed together (a key's runs stay together)
WAVES = 8         # parts of the initial order that are refined one after the other
_WHOLE = 1 << 29  # depth of a suffix that is known to its end
_Q = 7            # bytes of an initial bucket: seven symbols of nine bits, 0 after the end of a segment


def _grams(data: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The next ``_Q`` symbols at every place; ``rest`` bytes are left there in its segment."""
    gram = np.zeros(len(data), np.uint64)
    padded = np.concatenate((data.astype(np.uint16) + np.uint16(1), np.zeros(_Q, np.uint16)))
    for k in range(_Q):
        symbol = padded[k:k + len(data)].copy()
        symbol[rest <= k] = 0
        gram <<= np.uint64(9)
        gram |= symbol
    return gram


def _heads(key: np.ndarray) -> np.ndarray:
    """Per entry of a sorted array the place of the first entry equal to it."""
    new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    at = np.flatnonzero(new).astype(np.int32)
    return np.repeat(at, np.diff(np.append(at, len(key))))


def _refine(place: np.ndarray, pointer: np.ndarray, known: np.ndarray, depth: int) -> None:
    """Refine whole buckets, whose positions are ``place``, to ``depth`` bytes; pointers and depths are written at once."""
    while len(place):
        own, d = pointer[place].astype(np.int64), known[place]
        key = own * (len(pointer) + 1) + pointer[place + d]
        more = known[place + d]
        order = np.argsort(key)
        place, own, key, d, more = place[order], own[order], key[order], d[order], more[order]
        bucket, part = _heads(own), _heads(key)
        pointer[place] = own + part - bucket
        known[place] = np.minimum(d + more, _WHOLE)
        size = np.diff(np.append(np.flatnonzero(part == np.arange(len(part))), len(part)))
        again = np.repeat(size, size) > 1
        place = place[again & (known[place] < depth)]


def bucket_pointers(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, pointers) of all ``depth``-byte strings inside the segments of ``data``.

    Equal strings get equal pointers; pointers are ordered as the strings are.
    """
    n = np.maximum(sizes - depth + 1, 0)
    windows = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    if not len(windows):
        return windows, windows
    # four-byte places throughout: a shard is far smaller than 2 GB
    rest = np.repeat((starts + sizes).astype(np.int32), sizes) - np.arange(len(data), dtype=np.int32)
    gram = _grams(data, rest)
    order = np.argsort(gram).astype(np.int32)
    first = _heads(gram[order])
    pointer = np.empty(len(data), np.int32)
    pointer[order] = first
    # a suffix that ends inside its bucket's bytes is known whole
    known = np.where(rest <= _Q, np.int32(_WHOLE), np.int32(_Q))
    del rest
    shared = np.zeros(len(data), bool)
    shared[1:] = first[1:] == first[:-1]
    shared[:-1] |= shared[1:]
    edges = sorted({int(first[i]) for i in np.linspace(0, len(data) - 1, WAVES + 1).astype(int)[:-1]}) + [len(data)]
    for lo, hi in zip(edges, edges[1:]):                     # edges are bucket starts
        place = order[lo:hi]
        _refine(place[shared[lo:hi] & (known[place] < depth)], pointer, known, depth)
    del order, first, known
    by = windows[np.argsort(pointer[windows], kind="stable")]
    a, b = by[:-1], by[1:]
    same = np.ones(len(a), bool)
    for o in [*range(0, depth - _Q, _Q), max(0, depth - _Q)]:
        at = np.flatnonzero(same)
        if depth >= _Q:
            same[at] = gram[a[at] + o] == gram[b[at] + o]
        else:
            same[at] = (gram[a[at]] >> np.uint64(9 * (_Q - depth))) == (gram[b[at]] >> np.uint64(9 * (_Q - depth)))
    group = np.empty(len(data), np.int64)
    group[by] = _heads(np.concatenate(([0], np.cumsum(~same))))
    return windows, group[windows]


def later_copies(segments: list, n: np.ndarray, copies: np.ndarray, order: np.ndarray, length: int = LENGTH):
    """Window starts whose string also starts earlier: (segment, first, end) runs."""
    sizes = np.fromiter(map(len, segments), np.int64, len(segments))
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(segments), np.uint8)
    pos, pointer = bucket_pointers(data, starts, sizes, length)
    seg = np.repeat(np.arange(len(segments)), np.maximum(sizes - length + 1, 0))
    when = order[seg] * (1 << 32) + (pos - starts[seg])
    by = np.lexsort((when, pointer))
    p = pointer[by]
    later = np.zeros(len(pos), bool)
    later[by[1:]] = p[1:] == p[:-1]
    return mask_runs(later, seg, pos - starts[seg])


def mask_runs(flag: np.ndarray, seg: np.ndarray, offset: np.ndarray):
    """Maximal stretches of flagged windows per segment."""
    if not flag.any():
        e = np.empty(0, np.int64)
        return e, e, e
    new = np.concatenate(([True], seg[1:] != seg[:-1]))
    before = np.concatenate(([False], flag[:-1])) & ~new
    after = np.concatenate((flag[1:], [False])) & ~np.concatenate((new[1:], [True]))
    first, last = flag & ~before, flag & ~after
    return seg[first], offset[first], offset[last] + 1


def _finish(length):
    def finish(text, lo, hi, missing):
        if not len(lo):
            return len(text), 0, 0, hashlib.sha256(text).hexdigest(), None if missing else text
        gone = repeats.removed_tokens(lo, hi, length, len(text))
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        return len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept
    return finish


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_runs: int = repeats.HOT_RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs``."""
    spans = _spans(docs, length, gram, hot_runs)
    cut = _finish(length)
    return repeats.apply_spans(docs.select("doc_id", "text"), spans, lambda *a: cut(*a)[:4],
                               "n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _spans(docs, length, gram, hot_runs):
    return repeats.repeat_spans(docs, "byte", length, min(gram, length), lambda s, n, c, o: later_copies(s, n, c, o, length),
                                SHARD, keep_first=True, hot_runs=hot_runs)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_runs: int = repeats.HOT_RUNS) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; bytes of characters cut in two go too.

    Every row and column is kept; a null text stays null.
    """
    cut = _finish(length)

    def finish(text, lo, hi, missing):
        kept = cut(text, lo, hi, missing)[4]
        return (None if kept is None else kept.decode("utf-8", "ignore"),)

    plain, names = plain_names(docs)
    back = {names["doc_id"]: "doc_id", names["text"]: "text"}
    renamed = plain.withColumnsRenamed(back)
    order = [back.get(c, c) for c in names.values()]
    others = [c for c in order if c not in ("doc_id", "text")]
    return repeats.apply_spans(renamed, _spans(docs, length, gram, hot_runs), finish, "text string", "text", *others) \
        .select(*order).toDF(*names)
