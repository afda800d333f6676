"""A compressed FM-index over word numbers: Burrows-Wheeler transform in a wavelet matrix."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array, sorted by ``depth`` or more leading symbols (prefix doubling)."""
    n = len(text)
    rank = text.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    r = rank[order]
    head = np.concatenate(([True], r[1:] != r[:-1]))
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    d = 1
    while d < depth:
        shared = np.bincount(rank, minlength=n)[rank] > 1
        pos = np.flatnonzero(shared)
        if not len(pos):
            break
        nxt = np.where(pos + d < n, rank[np.minimum(pos + d, n - 1)] + 1, 0)
        pair = rank[pos] * (n + 1) + nxt
        by = np.argsort(pair)
        pair, pos = pair[by], pos[by]
        own = rank[pos]
        at = np.arange(len(pos))
        bucket = np.concatenate(([True], own[1:] != own[:-1]))
        group = np.concatenate(([True], pair[1:] != pair[:-1]))
        rank[pos] = own + at[group][np.cumsum(group) - 1] - at[bucket][np.cumsum(bucket) - 1]
        d *= 2
    return np.argsort(rank, kind="stable")


class Bits:
    """A bit vector of 64-bit words with a running count per word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        packed = np.concatenate((packed, np.zeros(-len(packed) % 8 + 8, np.uint8)))
        self.words = packed.view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.concatenate(([0], np.cumsum(ones)[:-1])).astype(np.uint32)
        self.zeros = n - int(ones.sum())

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before place ``i``."""
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w].astype(np.int64) + np.bitwise_count(self.words[w] & low)


class FMIndex:
    """Backward search over a text of symbols ``0 .. sigma-1``; symbol 0 parts segments."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int):
        # each separator is a symbol of its own while sorting, so no context runs across it
        seps = text == 0
        keyed = np.where(seps, np.cumsum(seps) - 1, text + int(seps.sum()))
        bwt = text[suffix_order(keyed, depth) - 1]
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        self.depth = max(1, int(sigma - 1).bit_length())
        self.levels = []
        seq = bwt
        for lv in range(self.depth - 1, -1, -1):
            bit = (seq >> lv) & 1
            self.levels.append(Bits(bit.astype(np.uint8)))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))
        self.origin = self._walk(np.arange(sigma), np.zeros(sigma, np.int64))

    def _walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, bits in enumerate(self.levels):
            one = bits.rank(i)
            i = np.where((c >> (self.depth - 1 - k)) & 1, bits.zeros + one, i - one)
        return i

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``c`` + pattern from the intervals of the pattern."""
        both = self._walk(np.concatenate((c, c)), np.concatenate((lo, hi)))
        base = self.less[c] - self.origin[c]
        return base + both[:len(c)], base + both[len(c):]


def matching_intervals(index: FMIndex, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, threshold: int,
                       at_least: int = 2):
    """Streams documents backwards through the index, all of them side by side.

    The matching statistic at an end position is the longest suffix of the words read so far
    that occurs ``at_least`` times. Intervals of ``threshold`` or more words are reported as
    (document, first word, end word); they cover every window that occurs so often.
    """
    doc = np.arange(len(starts))
    end = sizes.copy()                  # the pattern is [left, end) of each document
    left = end.copy()
    lo = np.zeros(len(doc), np.int64)
    hi = np.full(len(doc), len(text), np.int64)
    out = []
    live = end >= threshold
    doc, end, left, lo, hi = doc[live], end[live], left[live], lo[live], hi[live]
    while len(doc):
        nlo, nhi = index.extend(text[starts[doc] + left - 1], lo, hi)
        grows = nhi - nlo >= at_least
        left = left - grows
        lo, hi = np.where(grows, nlo, lo), np.where(grows, nhi, hi)
        stop = ~grows | (left == 0)
        if stop.any():
            found = stop & (end - left >= threshold)
            if found.any():
                out.append((doc[found], left[found], end[found]))
            # windows that reach further left have to end earlier
            new_end = np.where(found, left + threshold - 1, end - 1)
            end = np.where(stop, new_end, end)
            lo, hi = np.where(stop, 0, lo), np.where(stop, len(text), hi)
            done = stop & ((left == 0) & found | (end < threshold))
            left = np.where(stop, end, left)
            live = ~done
            doc, end, left, lo, hi = doc[live], end[live], left[live], lo[live], hi[live]
    if not out:
        e = np.empty(0, np.int64)
        return e, e, e
    return tuple(np.concatenate(x) for x in zip(*out))
