"""Substring dedup: words inside a 35-word window that also starts somewhere else go, everywhere.

Method: a compressed FM-index per shard (Burrows-Wheeler transform in a wavelet matrix, see
``fm_index``). The documents' segments are streamed through it: backward search gives, for each
end position, the longest stretch that occurs twice (matching statistics); stretches of 35 words
or more are reported. Shards come from ``repeats``: equal windows share a shard, and equal runs
are indexed once with their number of copies.

Defined cases: null or empty text: no words, the hash of the empty string; fewer than 35 words:
kept; fully repeated rows: separate documents, so both lose their repeated windows; null or equal
doc_id: rows stay apart; empty table: no rows; other columns of the input: ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from . import repeats
from .fm_index import FMIndex, matching_intervals

WINDOW = 35
GRAM = 12
SHARD = 1 << 20   # bytes of text indexed together


def index_segments(segments: list, window: int):
    """(index, word numbers, starts, sizes): segments laid end to end, parted by symbol 0."""
    numbers: dict = {}
    give = numbers.setdefault
    flat, sizes = [], np.empty(len(segments), np.int64)
    for i, s in enumerate(segments):
        words = s.split()
        sizes[i] = len(words)
        flat += [give(w, len(numbers) + 1) for w in words]
        flat.append(0)
    text = np.array(flat, np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    return FMIndex(text, len(numbers) + 1, max(window, int(sizes.max(initial=1)))), text, starts, sizes


def repeated_windows(segments: list, n: np.ndarray, copies: np.ndarray, order: np.ndarray, window: int = WINDOW):
    """(segment, first, end) window starts that occur twice in the shard; ``copies`` > 1 are known already."""
    index, text, starts, sizes = index_segments(segments, window)
    ask = np.flatnonzero(copies < 2)
    seg, left, end = matching_intervals(index, text, starts[ask], sizes[ask], window)
    return ask[seg], left, end - window + 1


def _finish(window):
    def finish(text, lo, hi, missing):
        words = text.split()
        if not len(lo):
            return len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest(), b" ".join(words)
        gone = repeats.removed_tokens(lo, hi, window, len(words)).tolist()
        kept = b" ".join([w for w, g in zip(words, gone) if not g])
        return len(words), sum(gone), hashlib.sha256(kept).hexdigest(), kept
    return finish


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_runs: int = repeats.HOT_RUNS,
                    with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and, if asked for, kept_text) of every row of ``docs``."""
    spans = repeats.repeat_spans(docs, "word", window, min(gram, window),
                                 lambda s, n, c, o: repeated_windows(s, n, c, o, window),
                                 SHARD, keep_first=False, hot_runs=hot_runs)
    cut = _finish(window)
    schema = "n_words long, n_removed long, kept_sha256 string"

    def finish(*a):
        out = cut(*a)
        return (*out[:3], out[3].decode()) if with_text else out[:3]

    return repeats.apply_spans(docs.select("doc_id", "text"), spans, finish,
                               schema + ", kept_text string" if with_text else schema)
