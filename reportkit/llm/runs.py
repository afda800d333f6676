"""Window keys: content-defined runs that bring equal token windows together.

Two equal windows of ``width`` tokens hold the same ``gram``-token pieces, so the
smallest piece hash of a window (its *key*) is equal too. Consecutive windows with one
key form a *run*; a run whose key occurs nowhere else holds no repeated window and needs
no further work. That turns "compare every window with every window" into an equality
join on about ``2 / (width - gram + 2)`` keys per token, and loses
nothing: a collision of keys can only add candidates. ``content``, a run's own hash, is used to take
whole runs as equal: two different runs would have to agree in it and in their key, 128 bits in all.

Everything here is numpy over one batch of texts at a time (bounded by the caller).
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_P = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_PINV = U(pow(int(_P), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_powers = {"n": 0}


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (in place)."""
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def _pow(n: int):
    if _powers["n"] < n + 1:
        size = max(1 << 16, 1 << int(n + 1).bit_length())
        for name, base in (("p", _P), ("q", _PINV)):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            _powers[name] = np.cumprod(a, dtype=np.uint64)
        _powers["n"] = size
    return _powers["p"], _powers["q"]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums; ``span_hash`` reads any span's hash from them."""
    p, _ = _pow(len(values))
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * p[:len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``[start, end)`` for arrays of spans (equal content, equal hash)."""
    _, q = _pow(len(prefix))
    return mix((prefix[end] - prefix[start]) * q[start])


def byte_values(data: bytes) -> np.ndarray:
    return _BYTE[np.frombuffer(data, dtype=np.uint8)]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` in UTF-8 bytes."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_values(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word of a UTF-8 buffer."""
    raw = np.frombuffer(data, dtype=np.uint8)
    s, e = word_bounds(raw)
    return span_hash(prefix_hash(_BYTE[raw]), s, e), s, e


def _sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    span, out = 1, h
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < w:
        out = np.minimum(out[:len(h) - w + 1], out[w - span:])
    return out


def find_runs(values: np.ndarray, bounds: np.ndarray, width: int, gram: int):
    """Runs of windows with one key, for texts laid end to end in ``values``.

    ``bounds``: token offset of each text, plus the end. Returns arrays
    ``text, start, n, key, content, own``: text number, first window (offset in the text),
    number of windows, key, hash of the run's whole content, and whether the key's piece
    occurs at two places of the run itself.
    """
    total = len(values)
    w = width - gram + 1
    empty = np.empty(0, dtype=np.int64)
    if total < width:
        return empty, empty, empty, empty.astype(U), empty.astype(U), empty.astype(bool)
    prefix = prefix_hash(values)
    _, q = _pow(total + 1)
    grams = mix((prefix[gram:] - prefix[:-gram]) * q[:total - gram + 1])
    key = _sliding_min(grams, w)
    # windows must lie inside one text
    n_win = np.maximum(np.diff(bounds) - width + 1, 0)
    first = np.zeros(len(key) + 1, dtype=bool)
    first[1:-1] = key[1:] != key[:-1]
    has = n_win > 0
    lo, hi = bounds[:-1][has], bounds[:-1][has] + n_win[has]
    first[lo] = True
    first[hi] = True
    first[-1] = True
    cuts = np.flatnonzero(first)
    cuts = cuts if len(cuts) and cuts[0] == 0 else np.concatenate(([0], cuts))
    start, n = cuts[:-1], np.diff(cuts)
    # very long runs (periodic text) are cut so that no piece is unbounded
    parts = -(-n // 512)
    if len(n) and parts.max() > 1:
        rep = np.repeat(np.arange(len(n)), parts)
        nth = np.arange(len(rep)) - np.repeat(np.cumsum(parts) - parts, parts)
        start, n = start[rep] + nth * 512, np.minimum(n[rep] - nth * 512, 512)
    text = np.searchsorted(bounds, start, side="right") - 1
    ok = start + n - 1 + width <= bounds[text + 1]
    start, n, text = start[ok], n[ok], text[ok]
    k = key[start]
    own = np.zeros(len(start), dtype=bool)
    step = max(1, 4_000_000 // w)
    at = np.arange(w)
    for i in range(0, len(start), step):
        s, m, kk = start[i:i + step], n[i:i + step], k[i:i + step, None]
        p1 = s + np.argmax(grams[s[:, None] + at] == kk, axis=1)
        b = s + m - 1
        p2 = b + w - 1 - np.argmax(grams[b[:, None] + at[::-1]] == kk, axis=1)
        own[i:i + step] = p1 != p2
    content = span_hash(prefix, start, start + n - 1 + width)
    return text, start - bounds[text], n, k, content, own
