"""Language ID with error-correcting output codes.

Method: every language gets a codeword of bits; one binary classifier per bit (logistic regression on hashed
character 1- to 3-grams) predicts it from the whole text; loss-weighted decoding sums, per codeword, the logistic
loss of each bit's margin, weighted by how well that bit's classifier did, and takes the nearest codeword. Results
whose two nearest codewords lie too close are flagged as ambiguous.

Learning uses text and lang of rows that are not held out (crc32 of doc_id modulo 5 is not 0), a sample of at most
about ``SAMPLE`` rows, shared out among the languages and drawn by a hash of doc_id; only the sampled rows' sparse
features reach the driver. Prediction reads the text alone, all of it, in every row.

Defined cases: null text or a text without letters: ``und``, score 0; no labelled rows: ``und`` everywhere; one
language: that one, score 1; null lang: not learned from, predicted as any other; null doc_id: not learned from, not
held out; repeated rows: one result row each; ties between codewords: the language first by name; empty table: no
rows; other columns of the input: ignored by ``identify``, kept by ``keep_identified``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import importable, plain_names

SAMPLE = 2400
DIMS = 1 << 13
EPOCHS = 40
BATCH = 128
AMBIGUOUS = 0.02    # least difference between the two best scores
PIECE = 1 << 20     # characters looked at together


@cache
def _letters() -> np.ndarray:
    """Code point -> code point of its lower case if it is a letter, else 0."""
    table = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def features(text: str | None) -> np.ndarray | None:
    """Counts of the hashed 1- to 3-grams of letters (word edges count as a letter); None without letters."""
    if not text:
        return None
    out, any_letter = np.zeros(DIMS, np.float32), False
    for at in range(0, len(text), PIECE):
        c = _letters()[np.frombuffer(text[max(0, at - 2):at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)]
        if not c.any():
            continue
        any_letter = True
        c = np.concatenate(([0], c, [0])).astype(np.uint32)
        c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]   # one edge between words
        h = c * np.uint32(0x9E3779B1)
        out += np.bincount(h[c != 0] >> np.uint32(19), minlength=DIMS)
        h2 = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + h[1:]
        out += np.bincount((h2 * np.uint32(0xC2B2AE35)) >> np.uint32(19), minlength=DIMS)
        if len(c) > 2:
            h3 = (h2[:-1] ^ (h2[:-1] >> np.uint32(13))) * np.uint32(0x27D4EB2F) + h[2:]
            out += np.bincount((h3 * np.uint32(0x165667B1)) >> np.uint32(19), minlength=DIMS)
    if not any_letter:
        return None
    out = np.sqrt(out)
    return out / np.linalg.norm(out)


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """(languages, bits) of +1/-1: all different two-way splits if few, else the best of random codes."""
    if languages < 2:
        return np.ones((languages, 0), np.int8)
    every = (1 << (languages - 1)) - 1 if languages <= 12 else 1 << 30
    bits = min(every, max(15, math.ceil(10 * math.log2(languages))))
    if every <= bits:
        cols = [[1 if (k >> (languages - 1 - i)) & 1 else -1 for i in range(languages)] for k in range(1, every + 1)]
        return np.array(cols, np.int8).T
    rng, best = np.random.default_rng(seed), None
    for _ in range(100):
        m = rng.choice(np.array([-1, 1], np.int8), (languages, bits))
        if (np.abs(m.astype(int).sum(axis=0)) == languages).any():
            continue                         # a bit that is equal for all says nothing
        gap = ((m.astype(int) @ m.T.astype(int)) - 2 * bits * np.eye(languages)).max()
        if best is None or gap < best[0]:
            best = (gap, m)
    return best[1]


@dataclass
class Model:
    languages: list
    codes: np.ndarray      # (languages, bits)
    weights: np.ndarray    # (dims, bits)
    bias: np.ndarray
    trust: np.ndarray      # (languages, bits), rows add up to the number of bits

    def losses(self, x: np.ndarray) -> np.ndarray:
        margin = x @ self.weights + self.bias
        loss = np.logaddexp(0, -margin[:, None, :] * self.codes[None])
        return (loss * self.trust[None]).sum(axis=2)

    def decode(self, x: np.ndarray):
        """(language number, score, lead over the second) per row."""
        if len(self.languages) == 1:
            one = np.ones(len(x))
            return np.zeros(len(x), int), one, one
        d = self.losses(x)
        p = np.exp(-(d - d.min(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        two = np.sort(p, axis=1)[:, -2:]
        return d.argmin(axis=1), two[:, 1], two[:, 1] - two[:, 0]


def fit(x: list, y: np.ndarray, languages: list, epochs: int = EPOCHS, seed: int = 11) -> Model:
    """``x``: (places, values) of each sampled row; minibatches are made dense one at a time."""
    codes = codewords(len(languages))
    bits = codes.shape[1]
    w, b = np.zeros((DIMS, bits), np.float32), np.zeros(bits, np.float32)
    rng, m2 = np.random.default_rng(seed), np.full((DIMS, bits), 1e-6, np.float32)

    def dense(rows):
        out = np.zeros((len(rows), DIMS), np.float32)
        for i, r in enumerate(rows):
            out[i, x[r][0]] = x[r][1]
        return out

    # every language counts alike, however few rows it has
    share = len(y) / (len(languages) * np.maximum(np.bincount(y, minlength=len(languages)), 1))
    for _ in range(epochs if bits else 0):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            xb, t = dense(rows), codes[y[rows]].astype(np.float32)
            g = -t / (1 + np.exp(np.clip(t * (xb @ w + b), -30, 30))) * share[y[rows], None].astype(np.float32) / len(rows)
            gw = xb.T @ g + 1e-5 * w
            m2 += gw * gw
            w -= 0.5 * gw / np.sqrt(m2)
            b -= 0.5 * g.sum(axis=0)
    right = np.full((len(languages), bits), 1e-3)
    for at in range(0, len(y) if bits else 0, BATCH):
        rows = np.arange(at, min(at + BATCH, len(y)))
        ok = (dense(rows) @ w + b) * codes[y[rows]] > 0
        np.add.at(right, y[rows], ok)
    right /= np.maximum(right.sum(axis=1, keepdims=True), 1e-9)
    return Model(languages, codes, w, b, right * bits)


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    importable(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~_held_out() & (F.length("text") > 0))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}   # one row a language
    languages = sorted(counts)
    if not languages:
        return Model([], np.ones((0, 0)), np.zeros((DIMS, 0)), np.zeros(0), np.ones((0, 0)))
    quota = max(20, sample // len(languages))
    chance = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, quota / n))) for k, n in sorted(counts.items())])
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def sparse(batches):
        for b in batches:
            langs, at, values = [], [], []
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                f = features(text)
                if f is not None:
                    nz = np.flatnonzero(f)
                    langs.append(lang)
                    at.append(nz.astype(np.int32))
                    values.append(f[nz])
            if langs:
                yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(at, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                                                 names=["lang", "places", "counts"])

    rows = (known.where(u < chance).select("lang", "text")
            .mapInArrow(sparse, "lang string, places array<int>, counts array<float>").toArrow())
    number = {k: i for i, k in enumerate(languages)}
    x = list(zip([np.asarray(v, np.int32) for v in rows.column("places").to_pylist()],
                 [np.asarray(v, np.float32) for v in rows.column("counts").to_pylist()]))
    y = np.array([number[k] for k in rows.column("lang").to_pylist()], int)
    order = sorted(range(len(y)), key=lambda i: (y[i], x[i][0].tobytes(), x[i][1].tobytes()))   # whatever order the rows came in
    return fit([x[i] for i in order], y[order], languages)


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns of ``docs`` plus lang_pred, score and ambiguous; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    wanted = list(dict.fromkeys([*keep, "text"]))

    def work(batches):
        m = shared.value
        for b in batches:
            texts = b.column("text")
            pred, score, ambiguous = ["und"] * b.num_rows, np.zeros(b.num_rows), np.zeros(b.num_rows, bool)
            for at in range(0, b.num_rows, 256) if m.languages else ():
                made = [(at + i, f) for i, f in enumerate(map(features, texts.slice(at, 256).to_pylist())) if f is not None]
                if made:
                    where = np.array([i for i, _ in made])
                    n, s, lead = m.decode(np.stack([f for _, f in made]))
                    score[where], ambiguous[where] = s, lead < AMBIGUOUS
                    for i, k in zip(where.tolist(), n.tolist()):
                        pred[i] = m.languages[k]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(pred), pa.array(score), pa.array(ambiguous)],
                names=[*keep, "lang_pred", "score", "ambiguous"])

    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["lang_pred string, score double, ambiguous boolean"])
    return docs.select(*wanted).mapInArrow(work, schema)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1) and ambiguous of every row of ``docs``."""
    return predict(docs.select("doc_id", "text"), train(docs, sample), "doc_id") \
        .select("doc_id", _held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def keep_identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows that have no language: no letters, or two languages equally near."""
    plain, names = plain_names(docs)
    held = predict(plain.withColumn("text", F.col(names["text"])), train(docs, sample), *names.values())
    return held.where((F.col("lang_pred") != "und") & ~F.col("ambiguous")).select(*names.values()).toDF(*names)
