"""Quality rules: lines labelled content or boilerplate by a linear-chain conditional random field.

Method: every line with a word is described by shares of its characters and words; a CRF with two labels scores the
lines and the steps between neighbouring labels; Viterbi decoding finds the best sequence of a text. A text whose content
lines hold at least ``CONTENT_SHARE`` of its words is kept, unless the base rules fail it.

The CRF is learned by gradient ascent (forward-backward) on the lines of at most about ``SAMPLE`` labelled rows, half of
either quality, drawn by a hash of doc_id. A text's quality is the first label of its lines; lines that clearly look like
the other quality change theirs (``line_labels``). Only those lines' features reach the driver. Counting, features and decoding work on whole texts, many at a time, in one pass without a shuffle.

Defined cases: null or empty text: no words, base_failed; no labelled rows: every line counts as content; null doc_id: kept
as a row, not learned from; a doc_id labelled twice: its lower quality counts; repeated rows: one result row each; ties in
decoding: content; lines that look equally like either kind keep their text's label; very long texts: read and decoded whole;
empty table: no rows; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import runs as R
from .common import importable

SAMPLE = 1500
CONTENT_SHARE = 0.5
SURE = 0.8
MIN_WORDS, WINDOW, REPEAT_PERCENT = 20, 8, 30
PIECE = 1 << 20     # bytes of text looked at together (one longer text is looked at alone)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_KINDS = {"symbol": b"#*$%&<>", "bar": b"|", "bang": b"!?", "digit": b"0123456789", "upper": bytes(range(65, 91)), "stop": b".,;:"}
_MARKED = {"symbol": 0.02, "bar": 0.02, "bang": 0.05, "upper": 0.5}     # shares from which a line is marked by the kind
FEATURES = ["bias", *_KINDS, "short", "long_words", "same_word", "seen_line", "first", *[f"much_{k}" for k in _MARKED]]


def _classes() -> np.ndarray:
    table = np.zeros((256, len(_KINDS)), bool)
    for i, chars in enumerate(_KINDS.values()):
        table[list(chars), i] = True
    return table


_CLASS = _classes()


@dataclass
class Described:
    """Counts per text and features per line with a word, for texts laid end to end."""
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    line_text: np.ndarray
    line_words: np.ndarray
    x: np.ndarray


def _sums(flag: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=total[1:])
    return total[hi] - total[lo]


def describe(texts: list[bytes]) -> Described:
    data = b"\n".join([*texts, b""])
    raw = np.frombuffer(data, np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1     # the line break after each text
    lo = np.concatenate(([0], ends[:-1] + 1)).astype(np.int64)
    word, ws, we = R.word_values(data)
    first_word = np.searchsorted(ws, lo)
    last_word = np.searchsorted(ws, ends)
    n_words = last_word - first_word
    text_of_word = np.repeat(np.arange(len(texts)), n_words)
    leads = (raw & 0xC0) != 0x80
    in_word = leads & ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    # words in windows found twice in their text
    prefix = R.prefix_hash(word)
    at = np.arange(max(0, len(word) - WINDOW + 1))
    at = at[text_of_word[at] == text_of_word[at + WINDOW - 1]] if len(at) else at
    h = R.mix(R.span_hash(prefix, at, at + WINDOW) + text_of_word[at].astype(np.uint64) * R.U(0x9E3779B97F4A7C15))
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(word) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + WINDOW, -1)
    repeated = np.cumsum(edge[:-1]) > 0
    # lines
    breaks = np.flatnonzero(raw == 10)
    ls = np.concatenate(([0], breaks[:-1] + 1)) if len(breaks) else np.empty(0, np.int64)
    fw, lw = np.searchsorted(ws, ls), np.searchsorted(ws, breaks)
    has = lw > fw
    ls, le, fw, lw = ls[has], breaks[has], fw[has], lw[has]
    line_text = np.searchsorted(ends, ls)
    lh = R.mix(R.span_hash(R.prefix_hash(R._BYTE[raw]), ls, le) + line_text.astype(np.uint64) * R.U(0x9E3779B97F4A7C15))
    by = np.lexsort((np.arange(len(lh)), lh))
    seen = np.zeros(len(lh), bool)
    seen[by[1:]] = lh[by[1:]] == lh[by[:-1]]
    words = lw - fw
    chars = np.maximum(_sums(in_word, ls, le), 1)
    x = np.zeros((len(ls), len(FEATURES)))
    x[:, 0] = 1
    for i in range(len(_KINDS)):
        x[:, 1 + i] = np.minimum(_sums(_CLASS[raw, i], ls, le) / chars, 1)
    k = 1 + len(_KINDS)
    x[:, k] = words < 5
    x[:, k + 1] = np.minimum(chars / words / 20, 1)
    again = np.concatenate(([False], word[1:] == word[:-1])) if len(word) else np.zeros(0, bool)
    x[:, k + 2] = _sums(again, np.minimum(fw + 1, lw), lw) / np.maximum(words - 1, 1)
    x[:, k + 3] = seen
    x[:, k + 4] = np.concatenate(([True], line_text[1:] != line_text[:-1])) if len(ls) else 0
    for i, (kind, share) in enumerate(_MARKED.items()):
        x[:, k + 5 + i] = x[:, FEATURES.index(kind)] > share
    return Described(n_words, _sums(in_word, lo, ends), _sums(_SYMBOL[raw], lo, ends),
                     np.bincount(line_text, seen, minlength=len(texts)).astype(np.int64),
                     np.bincount(text_of_word, repeated, minlength=len(texts)).astype(np.int64), line_text, words, x)


@dataclass
class Crf:
    emit: np.ndarray    # per feature: score of content less score of boilerplate
    step: np.ndarray    # (from, to), 0 boilerplate, 1 content


def _lanes(line_text: np.ndarray):
    """(first line, number of lines) of every text with lines, longest first."""
    if not len(line_text):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], line_text[1:] != line_text[:-1])))
    n = np.diff(np.concatenate((first, [len(line_text)])))
    by = np.argsort(-n, kind="stable")
    return first[by], n[by]


def viterbi(score: np.ndarray, step: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Best labels of all lines; the texts are decoded side by side."""
    label = np.zeros(len(score), np.int8)
    if not len(first):
        return label
    back = np.zeros((len(score), 2), np.int8)
    best = np.stack((np.zeros(len(first)), score[first]), axis=1)
    for t in range(1, int(n[0])):
        live = int(np.searchsorted(-n, -t))         # texts with more than t lines
        at = first[:live] + t
        come = best[:live, :, None] + step[None]
        back[at] = come[:, 1] >= come[:, 0]
        best[:live] = come.max(axis=1)
        best[:live, 1] += score[at]
    last = (best[:, 1] >= best[:, 0]).astype(np.int8)
    label[first + n - 1] = last
    for t in range(int(n[0]) - 1, 0, -1):
        live = int(np.searchsorted(-n, -t))
        at = first[:live] + t
        label[at - 1] = back[at, label[at]]
    return label


def learn(x: np.ndarray, line_text: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, ridge: float = 1e-3) -> Crf:
    """Maximum likelihood by gradient ascent (Adam) with forward-backward sums."""
    first, n = _lanes(line_text)
    emit, step = np.zeros(x.shape[1]), np.zeros((2, 2))
    if not len(first):
        return Crf(emit, step)
    m, v = np.zeros(len(emit) + 4), np.zeros(len(emit) + 4)
    inner = np.flatnonzero(np.concatenate(([False], line_text[1:] == line_text[:-1])))
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner - 1], y[inner]), 1)
    for i in range(1, rounds + 1):
        s = np.stack((np.zeros(len(x)), x @ emit), axis=1)
        fwd, bwd = s.copy(), np.zeros_like(s)
        for t in range(1, int(n[0])):
            at = first[:int(np.searchsorted(-n, -t))] + t
            fwd[at] = s[at] + np.logaddexp(fwd[at - 1, 0, None] + step[0], fwd[at - 1, 1, None] + step[1])
        for t in range(int(n[0]) - 1, 0, -1):
            at = first[:int(np.searchsorted(-n, -t))] + t
            come = s[at] + bwd[at]
            bwd[at - 1] = np.logaddexp(come[:, 0, None] + step[:, 0], come[:, 1, None] + step[:, 1])
        z = fwd + bwd
        total = np.logaddexp(z[:, 0], z[:, 1])
        p = np.exp(z[:, 1] - total)
        pair = np.exp(fwd[inner - 1, :, None] + step[None] + (s[inner] + bwd[inner])[:, None, :] - total[inner, None, None])
        grad = np.concatenate((x.T @ (y - p), (seen - pair.sum(axis=0)).ravel())) / len(x)
        grad -= ridge * np.concatenate((emit, step.ravel()))
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.99 ** i)) + 1e-8)
        emit, step = emit + move[:len(emit)], step + move[len(emit):].reshape(2, 2)
    return Crf(emit, step)


def line_labels(x: np.ndarray, line_text: np.ndarray, quality: np.ndarray, rounds: int = 3) -> np.ndarray:
    """Labels of lines from those of their texts: where a text holds lines that look like its own kind to a model of single
    lines and lines that look like the other kind (``SURE`` of either), the latter get the other label, and the model is fitted
    again. So prose in a bad text, and junk in a good one, become steps between labels that the chain can learn; a text without
    such a contrast, and at least one line of every text, keeps its label."""
    y, alone = quality.astype(np.int64), np.arange(len(x))
    both = np.bincount(y, minlength=2)
    if not both.all():
        return y
    for _ in range(rounds):
        m = learn(x, alone, y)
        p = 1 / (1 + np.exp(-np.clip(x @ m.emit, -40, 40)))
        own = np.where(quality == 1, p, 1 - p)
        best = np.zeros(line_text[-1] + 1)
        np.maximum.at(best, line_text, own)
        y = np.where((own < 1 - SURE) & (best[line_text] > SURE), 1 - quality, quality)
    return y


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


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Crf:
    importable(docs.sparkSession)
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r.quality: r.n for r in marks.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).where("quality IN (0, 1)").collect()}
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chance = F.lit(0.0)
    for q, n in sorted(counts.items()):
        chance = F.when(F.col("quality") == q, F.lit(min(1.0, sample / 2 / n))).otherwise(chance)
    some = F.broadcast(marks.where(u < chance).withColumnRenamed("quality", "_quality"))            # about ``sample`` rows

    def lines(batches):
        for b in batches:
            texts, quality = b.column("text").cast(pa.binary()).to_pylist(), b.column("_quality").to_numpy()
            for at, part in _pieces(texts):
                d = describe(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.bincount(d.line_text, minlength=len(part)).astype(np.int32)), pa.array(quality[at:at + len(part)].astype(np.int32)),
                     pa.array(np.split(d.x.ravel(), np.cumsum(np.bincount(d.line_text, minlength=len(part)))[:-1] * d.x.shape[1]),
                              pa.list_(pa.float64()))], names=["n", "quality", "x"])

    rows = (docs.select("doc_id", "text").join(some, "doc_id").where("text IS NOT NULL").select("text", "_quality")
            .mapInArrow(lines, "n int, quality int, x array<double>").toPandas())
    rows = rows[rows.n > 0]
    if not len(rows):
        return Crf(np.zeros(len(FEATURES)), np.zeros((2, 2)))
    rows["x"] = [np.asarray(x) for x in rows.x]
    rows = rows.assign(order=[x.tobytes() for x in rows.x]).sort_values(["quality", "n", "order"])   # whatever order the rows came in
    n = rows.n.to_numpy()
    x, line_text = np.concatenate(rows.x.to_list()).reshape(-1, len(FEATURES)), np.repeat(np.arange(len(n)), n)
    return learn(x, line_text, line_labels(x, line_text, np.repeat(rows.quality.to_numpy(), n)))


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, content_share: float = CONTENT_SHARE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share, and
    ``content`` (a flag per line with a word) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    def work(batches):
        crf = shared.value
        for b in batches:
            for at, part in _pieces(b.column("text").cast(pa.binary()).to_pylist()):
                d = describe(part)
                label = viterbi(d.x @ crf.emit, crf.step, *_lanes(d.line_text))
                inside = np.bincount(d.line_text, label * d.line_words, minlength=len(part))
                share = inside / np.maximum(d.n_words, 1)
                failed = (d.n_words < MIN_WORDS) | (100 * d.n_repeat_words > REPEAT_PERCENT * d.n_words)
                per = np.cumsum(np.bincount(d.line_text, minlength=len(part)))[:-1]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(at, len(part)),
                     *[pa.array(c.astype(np.int64)) for c in (d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words)],
                     pa.array(failed), pa.array(~failed & (share >= content_share)), pa.array(share),
                     pa.array(np.split(label.astype(bool), per), pa.list_(pa.bool_()))],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                           "content_share", "content"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, kept boolean, content_share double, content array<boolean>")
