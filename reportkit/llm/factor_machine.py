"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata of whole texts.

Method: a text is a sparse vector x: one place per word hash (counts scaled to length 1), one per structure statistic (shares
of kinds of characters, of lines and of words) and one per metadata figure (its size in code points, words and lines). The
score is ``sigma(w0 + w.x + sum of <v_i, v_j> x_i x_j over pairs)``; every place has a short factor v, and the pair sum is
taken in linear time as ``(|sum v_i x_i|^2 - sum |v_i|^2 x_i^2) / 2``. Scoring is one pass without a shuffle.

The machine is learned (logistic loss, Adagrad, minibatches) from at most about ``SAMPLE`` labelled rows, half of either
quality, drawn by a hash of doc_id; rows weigh as many labelled rows as they stand for, so scores are calibrated to the
labels. Only those rows' sparse vectors reach the driver. Rows whose crc32(doc_id as text) mod 4 is 2 are held out.
Labels, lang, source and doc_id are no inputs of a score.

Defined cases: null or empty text: a vector of the structure places alone, scored like any other; null doc_id: scored, not
held out, not learned from; a doc_id labelled twice: its lower quality counts; no labelled rows: score 0.5; labels of one
quality only: the score leans to it; repeated rows: one result row each, equal scores; long texts: read whole; empty table: no
rows; other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import runs as R
from .common import importable

SAMPLE = 6000
WORD_BITS, FACTORS = 14, 8
EPOCHS, BATCH, RATE, RIDGE = 12, 128, 0.1, 1e-5
THRESHOLD = 0.7
PIECE = 1 << 21     # bytes of text looked at together (one longer text is looked at alone)

_KINDS = [b"#*$%&<>", b"|", b"!?", b"0123456789", bytes(range(65, 91)), b".,;:", b"()[]{}=_/\\@~^+", b"\"'`-"]
STATS = 3 * len(_KINDS) + 8
DIMS = (1 << WORD_BITS) + STATS


def _classes() -> np.ndarray:
    table = np.zeros((256, len(_KINDS)), bool)
    for i, chars in enumerate(_KINDS):
        table[list(chars), i] = True
    return table


_CLASS = _classes()


def _between(flag: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flag, dtype=np.int64)))
    return total[hi] - total[lo]


def vectors(texts: list[bytes]):
    """(text, place, value) of all non-zero places, sorted by text and place."""
    n = len(texts)
    data = b"\n".join([*texts, b""])
    raw = np.frombuffer(data, np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    lo = np.concatenate(([0], ends[:-1] + 1)).astype(np.int64)
    word, ws, we = R.word_values(data)
    words = np.searchsorted(ws, ends) - np.searchsorted(ws, lo)
    of = np.repeat(np.arange(n), words)
    # hashed words: counts of distinct (text, place), scaled to length 1
    key = (of.astype(np.uint64) << R.U(WORD_BITS)) | (word >> R.U(64 - WORD_BITS))
    key, count = np.unique(key, return_counts=True)
    doc = (key >> R.U(WORD_BITS)).astype(np.int64)
    place = (key & R.U((1 << WORD_BITS) - 1)).astype(np.int64)
    length = np.sqrt(np.bincount(doc, count.astype(float) ** 2, minlength=n))
    value = count / length[doc]
    distinct = np.bincount(doc, minlength=n)
    # structure: shares of characters, of words and of lines by kind
    breaks = np.flatnonzero(raw == 10)
    starts = np.concatenate(([0], breaks[:-1] + 1)) if len(breaks) else np.empty(0, np.int64)
    fw, lw = np.searchsorted(ws, starts), np.searchsorted(ws, breaks)
    has = lw > fw
    starts, breaks, line_words = starts[has], breaks[has], (lw - fw)[has]
    line_of = np.searchsorted(ends, starts)
    lines = np.bincount(line_of, minlength=n)
    codes = _between((raw & 0xC0) != 0x80, lo, ends)
    size, some_words, some_lines = np.maximum(ends - lo, 1), np.maximum(words, 1), np.maximum(lines, 1)
    stats = np.zeros((n, STATS))
    for i in range(len(_KINDS)):
        flag = _CLASS[raw, i]
        total = np.concatenate(([0], np.cumsum(flag, dtype=np.int64)))
        stats[:, 3 * i] = np.sqrt((total[ends] - total[lo]) / size)
        stats[:, 3 * i + 1] = np.bincount(of, total[we] > total[ws], minlength=n) / some_words
        marked = (total[breaks] - total[starts]) * 20 > breaks - starts
        stats[:, 3 * i + 2] = np.bincount(line_of, marked, minlength=n) / some_lines
    k = 3 * len(_KINDS)
    stats[:, k] = 1
    again = np.concatenate(([False], (word[1:] == word[:-1]) & (of[1:] == of[:-1]))) if len(word) else np.zeros(0, bool)
    stats[:, k + 1] = np.bincount(of, again, minlength=n) / some_words
    lh = R.mix(R.span_hash(R.prefix_hash(R._BYTE[raw]), starts, breaks) + line_of.astype(np.uint64) * R.U(0x9E3779B97F4A7C15))
    by = np.lexsort((np.arange(len(lh)), lh))
    seen = np.zeros(len(lh), bool)
    seen[by[1:]] = lh[by[1:]] == lh[by[:-1]]
    stats[:, k + 2] = np.bincount(line_of, seen, minlength=n) / some_lines
    stats[:, k + 3] = np.bincount(line_of, line_words < 5, minlength=n) / some_lines
    stats[:, k + 4] = np.minimum(codes / some_words / 20, 1)
    # metadata: sizes
    stats[:, k + 5] = np.log1p(codes) / 12
    stats[:, k + 6] = np.log1p(words) / 10
    stats[:, k + 7] = distinct / some_words
    sd, sp = np.nonzero(stats)
    doc, place, value = np.concatenate((doc, sd)), np.concatenate((place, sp + (1 << WORD_BITS))), np.concatenate((value, stats[sd, sp]))
    by = np.lexsort((place, doc))
    return doc[by], place[by], value[by]


@dataclass
class Machine:
    bias: float
    w: np.ndarray       # (dims,)
    v: np.ndarray       # (dims, factors)

    def score(self, doc: np.ndarray, place: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """Probabilities of ``n`` sparse rows: linear in their non-zero places."""
        line = np.bincount(doc, self.w[place] * value, minlength=n)
        squares = np.bincount(doc, (self.v ** 2).sum(axis=1)[place] * value ** 2, minlength=n)
        sums = sum(np.bincount(doc, self.v[place, f] * value, minlength=n) ** 2 for f in range(self.v.shape[1]))
        return 1 / (1 + np.exp(-np.clip(self.bias + line + (sums - squares) / 2, -40, 40)))


def fit(x: list, y: np.ndarray, weight: np.ndarray, factors: int = FACTORS, seed: int = 5) -> Machine:
    """``x``: (places, values) of every sampled row; minibatches are made dense one at a time."""
    rng = np.random.default_rng(seed)
    w, v, b = np.zeros(DIMS, np.float32), rng.normal(0, 0.05, (DIMS, factors)).astype(np.float32), 0.0
    if not len(y):
        return Machine(0.0, w.astype(float), np.zeros((DIMS, factors)))
    weight = weight / weight.mean()
    mean = np.average(y, weights=weight)
    b = float(np.log((mean + 1e-3) / (1 - mean + 1e-3)))
    gw2, gv2, gb2 = np.full(DIMS, 1e-6, np.float32), np.full((DIMS, factors), 1e-6, np.float32), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            xb = np.zeros((len(rows), DIMS), np.float32)
            for i, r in enumerate(rows):
                xb[i, x[r][0]] = x[r][1]
            used = np.flatnonzero(xb.any(axis=0))       # only the places of this minibatch move
            xb = xb[:, used]
            sums = xb @ v[used]
            z = b + xb @ w[used] + ((sums ** 2).sum(axis=1) - (xb ** 2) @ (v[used] ** 2).sum(axis=1)) / 2
            g = (weight[rows] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)).astype(np.float32)
            gw = xb.T @ g + RIDGE * w[used]
            gv = xb.T @ (g[:, None] * sums) - v[used] * ((xb ** 2).T @ g)[:, None] + RIDGE * v[used]
            gw2[used] += gw * gw
            gv2[used] += gv * gv
            gb2 += float(g.sum()) ** 2
            w[used] -= RATE * gw / np.sqrt(gw2[used])
            v[used] -= RATE / 2 * gv / np.sqrt(gv2[used])
            b -= RATE * float(g.sum()) / gb2 ** 0.5
    return Machine(b, w.astype(float), v.astype(float))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _pieces(texts: list) -> Iterator[tuple[int, list[bytes]]]:
    held, size, at = [], 0, 0
    for i, t in enumerate(texts):
        if held and size + len(t or b"") > PIECE:
            yield at, held
            held, size, at = [], 0, i
        held.append(t or b"")
        size += len(held[-1])
    if held:
        yield at, held


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    importable(docs.sparkSession)
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("mark")))
    counts = {r.mark: r.n for r in marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).collect()}     # two rows
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chance = F.lit(0.0)
    for q, n in sorted(counts.items()):
        chance = F.when(F.col("mark") == q, F.lit(min(1.0, sample / 2 / n))).otherwise(chance)
    some = F.broadcast(marks.where(u < chance).select("doc_id", "mark"))        # about ``sample`` rows

    def sparse(batches):
        for b in batches:
            texts, mark = b.column("text").cast(pa.binary()).to_pylist(), b.column("mark")
            for at, part in _pieces(texts):
                doc, place, value = vectors(part)
                cut = np.searchsorted(doc, np.arange(1, len(part)))
                yield pa.RecordBatch.from_arrays(
                    [mark.slice(at, len(part)), pa.array(np.split(place.astype(np.int32), cut), pa.list_(pa.int32())),
                     pa.array(np.split(value.astype(np.float32), cut), pa.list_(pa.float32()))], names=["mark", "places", "counts"])

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(some, "doc_id").select("mark", "text")
            .mapInArrow(sparse, "mark int, places array<int>, counts array<float>").toArrow())
    y = np.array(rows.column("mark").to_pylist(), int)
    x = list(zip([np.asarray(p, np.int32) for p in rows.column("places").to_pylist()],
                 [np.asarray(p, np.float32) for p in rows.column("counts").to_pylist()]))
    order = sorted(range(len(y)), key=lambda i: (y[i], x[i][0].tobytes(), x[i][1].tobytes()))    # whatever order the rows came in
    y = y[order]
    drawn = np.bincount(y, minlength=2)
    weight = np.array([counts.get(q, 0) / max(1, drawn[q]) for q in (0, 1)])[y]
    return fit([x[i] for i in order], y, weight)


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    def work(batches):
        machine = shared.value
        for b in batches:
            for at, part in _pieces(b.column("text").cast(pa.binary()).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(at, len(part)), pa.array(machine.score(*vectors(part), len(part)))], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
