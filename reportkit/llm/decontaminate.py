"""Benchmark decontamination by spaced-seed hashing.

Method: fixed masks choose some of the words of a window and ignore the others, so a changed word
under an ignored place does not change the hash. Every window of every training text and of every
benchmark item is hashed under each mask, the hashes are joined, and around each hit the words of both
sides are compared place by place: a stretch of ``overlap`` words (the whole item, if shorter) that holds
the hit and agrees in 0.8 of its words or more is a leak.

Every stretch that is a leak is hit: the masks of an item are taken by its length (``MASKS``), and for each length up to ``overlap``
every way of changing a fifth of the words leaves at least one window of one mask untouched (enumerated in the tests). Items of one to
four words are hashed whole. Only the masks of the lengths that the benchmark has are used on the texts. Other values of ``overlap`` or a
lower ``similarity`` take the longest run of words that must be unchanged (``masks_for``). The benchmark index is broadcast only after
its rows are counted (``BROADCAST_ROWS``); beyond that it is an ordinary shuffled join. Everything is DataFrame code.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.

Defined cases: null or empty text, or no words: no leak on either side; null doc_id
or item_id: kept as null in the pairs; repeated rows: separate documents, a pair each; repeated items: a pair each;
empty tables: no pairs, every document stays; other columns: ignored by ``leaks``, kept by ``decontaminate``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, numbered, plain_names, written
from .license_scan import WORD

MASKS = {       # by the fewest words of the item
    1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",),
    5: ("111", "1101"),
    8: ("111011", "11001011", "101010011"),
    12: ("1110111", "111000001011", "10110001011"),
}
OVERLAP = 24
SIMILARITY = 0.8
BROADCAST_ROWS = 1_000_000   # at most about 50 MB of index


def _words(c: str) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(F.col(c), F.lit(""))), F.lit(WORD), F.lit(0))


def masks_for(words: int, masks=MASKS, overlap: int = OVERLAP, similarity: float = SIMILARITY) -> tuple[str, ...]:
    """Masks that hit every leak of an item of ``words`` words (1 at least)."""
    n = min(words, overlap)
    if overlap <= OVERLAP and similarity >= SIMILARITY:
        return masks[max(k for k in masks if k <= n)]
    same = next(k for k in range(1, n + 1) if k / n >= similarity or k == n)
    return ("1" * -(-same // (n - same + 1)),)      # n - same changes leave so many runs of unchanged words at most


def seeds(rows: DataFrame, masks) -> DataFrame:
    """(id, text) -> (id, ends, at, seed): the hash of every window of every text under every mask, in one pass.

    ``at`` counts over the windows of all masks, ``ends`` says where each mask's windows end (see ``_pos``).
    explode_outer: the filter that Spark infers for explode would compute every array twice.
    """
    hashed = rows.select("id", F.transform(_words("text"), lambda w: F.xxhash64(w)).alias("w"))

    def under(mask: str) -> Column:
        chosen = [k for k, c in enumerate(mask) if c == "1"]
        return F.when(F.size("w") >= len(mask), F.transform(
            F.sequence(F.lit(0), F.size("w") - len(mask)),
            lambda i: F.xxhash64(F.lit(int(mask, 2)), *[F.get("w", i + k) for k in chosen]))).otherwise(F.array().cast("array<bigint>"))

    sizes = [F.greatest(F.size("w") - len(m) + 1, F.lit(0)) for m in masks]
    ends = F.array(*[reduce(Column.__add__, sizes[:m + 1]) for m in range(len(masks))])
    flat = hashed.select("id", ends.alias("ends"), F.concat(*[under(m) for m in masks]).alias("seeds"))
    return flat.select("id", "ends", F.posexplode_outer("seeds").alias("at", "seed")).where("seed IS NOT NULL")


def _pos() -> Column:
    """First word of the window numbered ``at``."""
    mask = F.size(F.filter("ends", lambda e: e <= F.col("at")))
    return F.col("at") - F.coalesce(F.get("ends", mask - 1), F.lit(0))


def leaks(docs: DataFrame, benchmark: DataFrame, masks=MASKS, overlap: int = OVERLAP,
          similarity: float = SIMILARITY) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds.

    _row (the document's row), doc_id, item_id, doc_word, item_word (where the best stretch starts),
    n_words (its length), similarity.
    """
    texts = numbered(docs, "doc_id", "text")
    items = numbered(benchmark, "item_id", "text").select(F.col("_row").alias("item"), "item_id", "text", _words("text").alias("item_words"))
    lengths = [r.n for r in items.select(F.least(F.size("item_words"), F.lit(overlap)).alias("n")).where("n > 0").distinct().collect()]
    by_masks: dict = {}                           # at most ``overlap`` different lengths
    for n in sorted(lengths):
        by_masks.setdefault(masks_for(n, masks, overlap, similarity), []).append(n)
    by_masks = by_masks or {masks_for(overlap, masks, overlap, similarity): [overlap]}
    index = reduce(DataFrame.unionByName, [
        seeds(items.where(F.least(F.size("item_words"), F.lit(overlap)).isin(ns)).select(F.col("item").alias("id"), "text"), m)
        .select(F.col("id").alias("item"), _pos().alias("item_pos"), "seed") for m, ns in by_masks.items()])
    if index.count() <= BROADCAST_ROWS:
        index = F.broadcast(index)
    used = list(dict.fromkeys(k for m in by_masks for k in m))
    found = seeds(texts.select(F.col("_row").alias("id"), "text"), used).join(index, "seed")
    hits = (found.select(F.col("id").alias("_row"), "item", (_pos() - F.col("item_pos")).alias("shift"))
            .groupBy("_row", "item").agg(F.collect_set("shift").alias("shifts"))
            .join(items.select("item", "item_id", "item_words"), "item")
            .groupBy("_row").agg(F.collect_list(F.struct("item_id", "item_words", "shifts")).alias("found")))
    hits = written(hits)
    if hits.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(hits.select("_row")), "_row", "left_semi")     # the other texts stay where they are
    both = texts.join(hits, "_row").select("_row", "doc_id", "found", _words("text").alias("words"))

    def agreed(item: Column) -> Column:
        """Per shift of the item against the text, which of its words stand there."""
        return F.transform(item["shifts"], lambda d: F.struct(d.alias("shift"), F.transform(
            item["item_words"], lambda w, k: F.coalesce(F.get("words", d + k) == w, F.lit(False))).alias("same")))

    def verify(item: Column, hit: Column) -> Column:
        """The best stretch of the item at one shift: struct(similarity, start in the text, in the item, length)."""
        size = F.size(item["item_words"])
        n = F.least(size, F.lit(overlap))
        return F.array_max(F.transform(F.sequence(F.lit(0), size - n), lambda s: F.struct(
            (F.size(F.filter(F.slice(hit["same"], s + 1, n), lambda same: same)) / n).alias("similarity"),
            (hit["shift"] + s).alias("doc_word"), s.alias("item_word"), n.alias("n_words"))))

    best = F.transform("found", lambda item: F.struct(
        item["item_id"].alias("item_id"),
        F.array_max(F.transform(agreed(item), lambda hit: verify(item, hit))).alias("best")))
    return (both.select("_row", "doc_id", F.explode_outer(best).alias("b"))
            .where(F.col("b.best.similarity") >= similarity)
            .select("_row", "doc_id", "b.item_id", F.col("b.best.doc_word").cast("long").alias("doc_word"),
                    F.col("b.best.item_word").cast("long").alias("item_word"),
                    F.col("b.best.n_words").cast("long").alias("n_words"), "b.best.similarity"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    held = written(leaks(docs, benchmark, **how).select("_row").distinct())
    if held.count() <= BROADCAST_ROWS:
        held = F.broadcast(held)
    plain, names = plain_names(docs)
    return numbered(plain, *names.values()).join(held, "_row", "left_anti").select(*names.values()).toDF(*names)
