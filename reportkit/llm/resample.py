"""Target-distribution importance resampling: documents drawn in proportion to how much they look like a target text set.

Method: hashed n-grams, counted by Arrow kernels. A batch of texts is lower-cased (``ascii_lower``), split at everything
that is no word character (``split_pattern_regex``), laid end to end (``list_flatten``) and coded (``dictionary_encode``).
N-grams are formed from the code array and its shifts: a gram is the pair (gram one word shorter, next word), every distinct
pair gets its CRC once, continued from the CRC of the shorter gram, and its bucket is ``take``-n back to the places. The
gains of the buckets are summed per text by a segment reduce. Two passes over the corpus: bucket counts, then scores; the
target's buckets are counted the same way. Only the ``buckets`` sums of either side reach the driver.

A draw without replacement in proportion to the weights is a top-k by weight plus Gumbel noise; the noise comes from a
hash of doc_id. Scores are whole numbers in a range of about 120,000, so the rank of a row is the number of rows with a higher
score (a table of at most that many rows) plus its place among equal scores.

Defined cases: null or empty text: no words, weight 0, never drawn; null doc_id: noise of the empty id, after the other ids among
equal scores; rows that share doc_id and score: ranked one after the other in file order; long texts are counted whole;
empty target: gains of its zero counts; empty table: no rows; other columns of the inputs are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportkit.operators.windows import seq_number

from .common import importable, numbered, written

MAX_N, BUCKETS = 1, 10_000
PERCENT, MIN_WORDS, SEED = 10, 20, "2024"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PIECE = 1 << 23     # bytes of text looked at together (one longer text is looked at alone)


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about ``PIECE`` bytes."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + PIECE, "right")))
        yield texts.slice(at, upto - at)
        at = upto


def gram_buckets(texts: pa.Array, max_n: int = MAX_N, buckets: int = BUCKETS):
    """(words per text, [(text of each gram, bucket of each gram) for n = 1..max_n])."""
    whole = texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts))))     # ascii_lower misreads a slice without nulls: copy it
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(whole, "")), NOT_WORD)
    words = pc.list_flatten(lists)
    parent = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    real = pc.greater(pc.binary_length(words), 0)
    parent = parent[real.to_numpy(zero_copy_only=False)]
    coded = words.filter(real).dictionary_encode()
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    spelled = [b" " + w for w in coded.dictionary.cast(pa.large_binary()).to_pylist()]
    crc = np.fromiter((zlib.crc32(w[1:]) for w in spelled), np.uint32, len(spelled))
    grams, of, out = word, parent, []
    for n in range(1, max_n + 1):
        if n > 1:       # gram of n words = (gram of n - 1 words, word after it), inside one text
            inside = np.flatnonzero(of[:len(of) - 1] == parent[n - 1:len(of) + n - 2]) if len(of) > 1 else np.empty(0, np.int64)
            pair = grams[inside] * max(1, len(spelled)) + word[inside + n - 1]
            distinct, grams_next = np.unique(pair, return_inverse=True)
            crc = np.fromiter((zlib.crc32(spelled[w], int(crc[g])) for g, w in zip(*(a.tolist() for a in np.divmod(distinct, max(1, len(spelled)))))),
                              np.uint32, len(distinct))
            # keep the arrays aligned with the places of the words
            grams, of = np.zeros(len(of) - 1, np.int64) if len(of) else grams, of[:-1].copy()
            alive = np.zeros(len(of), bool)
            alive[inside] = True
            grams[inside] = grams_next
            of = np.where(alive, of, -1)
            places = inside
        else:
            places = np.arange(len(of))
        bucket = pc.take(pa.array((crc % np.uint32(buckets)).astype(np.int64)), pa.array(grams[places])).to_numpy(zero_copy_only=False)
        out.append((of[places], bucket))
    return np.bincount(parent, minlength=len(texts)), out


def bucket_counts(rows: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """Grams per bucket over all texts of ``rows``; one row per bucket and task is shuffled."""
    importable(rows.sparkSession)

    def work(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for part in pieces(b.column("text")):
                for _, bucket in gram_buckets(part, max_n, buckets)[1]:
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    sums = rows.select("text").mapInArrow(work, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():            # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    big_s, big_t, b = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((float(t + 1) * float(big_s + b)) / (float(s + 1) * float(big_t + b))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, max_n: int = MAX_N) -> DataFrame:
    """_row, doc_id, n_words, n_features and weight of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def work(batches):
        gain = shared.value
        for b in batches:
            at = 0
            for part in pieces(b.column("text")):
                words, grams = gram_buckets(part, max_n, len(gain))
                n, total = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                for of, bucket in grams:
                    edges = np.searchsorted(of, np.arange(len(part) + 1))
                    sums = np.concatenate(([0], np.cumsum(gain[bucket])))
                    n += np.diff(edges)
                    total += sums[edges[1:]] - sums[edges[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [b.column("_row").slice(at, len(part)), b.column("doc_id").slice(at, len(part)),
                     *[pa.array(c) for c in (words, n, np.where(n > 0, total // np.maximum(n, 1), 0))]],
                    names=["_row", "doc_id", "n_words", "n_features", "weight"])
                at += len(part)

    rows = numbered(docs, F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(work, "_row long, doc_id long, n_words long, n_features long, weight long")


def with_noise(weighed: DataFrame, seed: str = SEED) -> DataFrame:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    return weighed.withColumn("score", F.col("weight") + gumbel)


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``rank`` 1, 2, ... of the ``floor(percent * N / 100)`` best of the N rows with ``min_words`` words; null for the rest.

    ``scored`` (_row, doc_id, n_words, score, ...) is read three times: pass a written table.
    """
    fit = F.col("n_words") >= min_words
    sums = scored.where(fit).groupBy("score").agg(F.count(F.lit(1)).alias("_n"))        # bounded by the range of the scores
    down = Window.orderBy(F.col("score").desc())
    above = sums.select(F.col("score").alias("_score"), (F.sum("_n").over(down) - F.col("_n")).alias("_above"),
                        F.floor(F.sum("_n").over(Window.partitionBy()) * percent / 100).cast("long").alias("_draws"))
    j = scored.join(F.broadcast(above), F.col("score") == F.col("_score"), "left").drop("_score")
    near = F.coalesce(fit & (F.col("_above") < F.col("_draws")), F.lit(False))
    kept = [c for c in scored.columns]
    far = j.where(~near).select(*kept, F.lit(None).cast("long").alias("rank"))
    # place among equal scores: rows before by doc_id, then the place among rows of one doc_id
    near = j.where(near)
    ids = near.groupBy("score", "doc_id").agg(F.count(F.lit(1)).alias("_m"))
    w = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last())
    ids = ids.select(F.col("score").alias("_s"), F.col("doc_id").alias("_d"), (F.sum("_m").over(w) - F.col("_m")).alias("_less"))
    near = seq_number(near, ["score", "doc_id"], ["_row"], "_nth", F.shiftright("_row", 33))
    near = near.join(ids, (F.col("score") == F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("_d")))
    place = F.col("_above") + F.col("_less") + F.col("_nth")
    return far.unionByName(near.select(*kept, F.when(place <= F.col("_draws"), place).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null: not drawn) of every row of ``docs``."""
    gains = bucket_gains(bucket_counts(docs, max_n, buckets), bucket_counts(target, max_n, buckets))
    scored = written(with_noise(weigh(docs, gains, max_n), seed))      # numbers only, read by each step of the ranking
    return draw(scored, percent, min_words).drop("_row")


# every byte's CRC step, then the CRC of a list of bytes, for engines without a crc32 function
CRC_TABLE = """SELECT list(list_reduce(list_prepend(i, [1, 1, 1, 1, 1, 1, 1, 1]),
    lambda s, b: CASE WHEN s % 2 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END) ORDER BY i) AS steps
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))"""


def crc_sql(text: str, steps: str = "steps") -> str:
    """DuckDB SQL: unsigned CRC-32 of the UTF-8 bytes of ``text``."""
    codes = f"list_transform(range(1, 2 * octet_length(encode({text})) + 1, 2), " \
            f"lambda i: CAST(instr('0123456789ABCDEF', substr(hex(encode({text})), i, 1)) - 1 AS BIGINT) * 16 " \
            f"+ instr('0123456789ABCDEF', substr(hex(encode({text})), i + 1, 1)) - 1)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), " \
           f"lambda s, b: xor(s >> 8, {steps}[CAST((xor(s, b) & 255) + 1 AS BIGINT)])), 4294967295)"


def oracle_sql(buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED) -> str:
    """DuckDB SQL of ``resample`` with single words."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"unnest(regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"
    return f"""
        WITH crc AS ({CRC_TABLE}),
        d AS (SELECT doc_id, {words} AS w FROM documents),
        t AS (SELECT {words} AS w FROM benchmark),
        dw AS (SELECT doc_id, w, count(*) AS n FROM d GROUP BY doc_id, w),
        tw AS (SELECT w, count(*) AS n FROM t GROUP BY w),
        code AS (SELECT w, {crc_sql('w')} % {buckets} AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM tw) CROSS JOIN crc),
        s AS (SELECT bucket, sum(n) AS s FROM dw JOIN code USING (w) GROUP BY bucket),
        g AS (SELECT bucket, sum(n) AS t FROM tw JOIN code USING (w) GROUP BY bucket),
        sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) + {buckets} AS big_s, (SELECT coalesce(sum(t), 0) FROM g) + {buckets} AS big_t),
        gain AS (SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(big_s AS DOUBLE))
                     / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST(big_t AS DOUBLE)))) AS BIGINT) AS gain
                 FROM s FULL JOIN g USING (bucket) CROSS JOIN sums),
        per AS (SELECT doc_id, sum(n) AS n, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
                FROM dw JOIN code USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
        scored AS (
            SELECT x.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('{seed}:' || x.doc_id), 1, 8) AS BIGINT) AS DOUBLE)
                       + 0.5) / 4294967296))) AS BIGINT) AS score
            FROM documents x LEFT JOIN per USING (doc_id)),
        drawn AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS fit
            FROM scored WHERE n_features >= {min_words})
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= ({percent} * fit) // 100 THEN place END AS rank
        FROM scored LEFT JOIN drawn USING (doc_id)"""
