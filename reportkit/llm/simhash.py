"""SimHash near-dedup: 64-bit fingerprints that differ in at most 3 bits are linked.

Method: deletion-variant signatures. A fingerprint is cut into only 2 segments of 32 bits, so
of two fingerprints that differ in 3 bits or fewer one segment differs in at most one bit. Every
segment is indexed once per bit with that bit wiped out (64 keys a fingerprint); such a pair then
agrees in a key, an equality join finds it, and the bit distance of the whole is verified.

Copies are collapsed first: the index holds different fingerprints only. Fingerprints that share
a key are linked by a spanning forest of their verified links, never by all pairs. A key with more
than ``HOT`` fingerprints is split by the deletion variants of the other segment's halves (the
argument above holds again: of 3 differing bits in two halves, one half has at most one).

Defined cases: null, empty or blank text: fingerprint zero, linked like any other; null doc_id: never
the component id unless all of the group are null (then null); repeated rows: one result row each;
empty table: no rows; other columns of the input: ignored by ``simhash_groups``, kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, numbered, plain_names, written
from .components import connected_components

SHINGLE = 3
MAX_BITS = 3     # 2 segments: complete up to 3 bits
SEED = 42
HOT = 2048
BROADCAST_ROWS = 1_000_000   # row numbers, 8 bytes each


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of every word shingle, repeats included."""
    words = text.lower().split()          # bytes: only A-Z are folded
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    last = ends[shingle - 1:].tolist() if len(words) >= shingle else [len(flat)]
    digest = xxhash.xxh64_intdigest
    counts, total = np.zeros(64, np.int64), len(last)
    for at in range(0, total, 1 << 16):
        h = np.array([digest(flat[s:e], SEED) for s, e in zip(starts[at:at + (1 << 16)], last[at:at + (1 << 16)])], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(_row, doc_id, fp) per row; fp holds the 64 bits as a signed long."""

    def work(batches):
        for b in batches:
            fp = np.array([fingerprint(t or b"", shingle) for t in b.column("text").cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("doc_id"), pa.array(fp.view(np.int64))],
                                             names=["_row", "doc_id", "fp"])

    return numbered(docs, F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "_row long, doc_id long, fp long")


def _variants(fp, bits: int, first: int):
    """Keys (segment, wiped bit, the rest) of the two ``bits``-wide segments of ``fp`` from bit ``first`` up."""
    def key(i):
        seg, bit = F.floor(i / bits).cast("long"), (i % bits).cast("long")
        part = F.call_function("shiftrightunsigned", fp, (seg * bits + first).cast("int")).bitwiseAND(F.lit((1 << bits) - 1))
        wiped = F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))
        return part.bitwiseAND(F.bitwise_not(wiped)) + (i.cast("long") * F.lit(1 << bits))
    return F.transform(F.sequence(F.lit(0), F.lit(2 * bits - 1)), key)


def _forest(fp: np.ndarray, bits: int):
    """Verified links inside one small group, as edges to the least member of each tree."""
    label, step = np.arange(len(fp)), max(1, (1 << 22) // len(fp))
    while True:
        nxt = np.concatenate([
            np.where(np.bitwise_count(fp[i:i + step, None] ^ fp[None, :]) <= bits, label[None, :], len(fp)).min(axis=1)
            for i in range(0, len(fp), step)])
        nxt = nxt[nxt]
        if (nxt == label).all():
            break
        label = nxt
    at = np.flatnonzero(label != np.arange(len(fp)))
    return fp[at], fp[label[at]]


def link_groups(keyed: DataFrame, bits: int, hot: int) -> DataFrame:
    """(k1, k2, fp) -> rows (u, v, k1, k2): a link, or - k1 not null - a member of a key beyond ``hot``."""

    def work(batches):
        pend, pend_key, spilling = [], None, False
        for b in batches:
            if not b.num_rows:
                continue
            k1, k2, fp = (b.column(c).to_numpy() for c in ("k1", "k2", "fp"))
            fp = fp.view(np.uint64)
            cut = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
            edges = np.concatenate(([0], cut, [len(fp)]))
            size = np.diff(edges)
            us, vs, ks, ls = [], [], [], []

            def close():
                g = np.unique(np.concatenate(pend))
                if len(g) > 1:
                    u, v = _forest(g, bits)
                    us.append(u)
                    vs.append(v)
                    ks.append(np.full(len(u), -1, np.int64))
                    ls.append(ks[-1])

            head, tail = 0, len(size) - 1
            if pend_key is not None and (k1[0], k2[0]) != pend_key:
                if not spilling:
                    close()
                pend, pend_key, spilling = [], None, False
            for g in [0] if tail == 0 else [0, tail]:   # first and last group may go on in other batches
                part, key = fp[edges[g]:edges[g + 1]], (k1[edges[g]], k2[edges[g]])
                if pend_key is not None and key != pend_key:
                    if not spilling:
                        close()
                    pend, spilling = [], False
                pend_key = key
                pend.append(part)
                if spilling or sum(map(len, pend)) > hot:
                    spilling = True
                    m = np.concatenate(pend)
                    us.append(m)
                    vs.append(m)
                    ks.append(np.full(len(m), key[0], np.int64))
                    ls.append(np.full(len(m), key[1], np.int64))
                    pend = []
            inner = np.arange(1, tail)
            two = inner[size[inner] == 2]
            a, c = fp[edges[two]], fp[edges[two] + 1]
            ok = (np.bitwise_count(a ^ c) <= bits) & (a != c)
            us.append(a[ok])
            vs.append(c[ok])
            ks.append(np.full(int(ok.sum()), -1, np.int64))
            ls.append(ks[-1])
            for g in inner[size[inner] > 2]:
                part = np.unique(fp[edges[g]:edges[g + 1]])
                if len(part) > hot:
                    u, v, k, k_2 = part, part, k1[edges[g]], k2[edges[g]]
                else:
                    (u, v), k, k_2 = _forest(part, bits), -1, -1
                us.append(u)
                vs.append(v)
                ks.append(np.full(len(u), k, np.int64))
                ls.append(np.full(len(u), k_2, np.int64))
            u, v, k, k_2 = (np.concatenate(x) for x in (us, vs, ks, ls))
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64)), pa.array(k, mask=k < 0), pa.array(k_2, mask=k < 0)],
                                                 names=["u", "v", "k1", "k2"])
        if pend and not spilling:
            g = np.unique(np.concatenate(pend))
            u, v = _forest(g, bits) if len(g) > 1 else (g[:0], g[:0])
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64)),
                                                  pa.nulls(len(u), pa.int64()), pa.nulls(len(u), pa.int64())], names=["u", "v", "k1", "k2"])

    return keyed.repartition("k1", "k2").sortWithinPartitions("k1", "k2").mapInArrow(work, "u long, v long, k1 long, k2 long")


def near_links(fps: DataFrame, bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """Different fingerprints (fp) -> links (u, v), enough of them to connect what is linked."""
    if not 0 <= bits <= 3:
        raise ValueError("two segments with one wiped bit cover at most 3 differing bits")
    importable(fps.sparkSession)
    keyed = fps.select("fp", F.explode(_variants(F.col("fp"), 32, 0)).alias("k1"))
    first = written(link_groups(keyed.select("k1", F.lit(0).cast("long").alias("k2"), "fp"), bits, hot))
    links = first.where("k1 IS NULL").select("u", "v")
    over = first.where("k1 IS NOT NULL").select("k1", F.col("u").alias("fp"))
    if not over.isEmpty():
        # key 0..31 wipes the low segment, so the halves of the high one tell its members apart
        low = F.col("k1") < F.lit(1 << 37)
        other = F.when(low, _variants(F.col("fp"), 16, 32)).otherwise(_variants(F.col("fp"), 16, 0))
        second = written(link_groups(over.select("k1", "fp", F.explode(other).alias("k2")), bits, hot))
        links = links.unionByName(second.where("k1 IS NULL").select("u", "v"))
        over = second.where("k1 IS NOT NULL").select("k1", "k2", F.col("u").alias("fp"))
        if not over.isEmpty():
            # what is left is the other half of that half: 16 bits, cut once more. Members of a key now agree in 31 + 15 + 7 bits, so
            # at most 2,048 different fingerprints share one
            low16 = F.col("k2") < F.lit(1 << 20)
            at = [[_variants(F.col("fp"), 8, base + half) for half in (16, 0)] for base in (32, 0)]
            rest = F.when(low, F.when(low16, at[0][0]).otherwise(at[0][1])).otherwise(F.when(low16, at[1][0]).otherwise(at[1][1]))
            third = over.select((F.col("k1") * F.lit(1 << 21) + F.col("k2")).alias("k1"), F.explode(rest).alias("k2"), "fp")
            links = links.unionByName(link_groups(third, bits, 1 << 62).select("u", "v"))
    return links


def _groups(docs: DataFrame, shingle: int, bits: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """(rows, component of each fingerprint with its least member)."""
    importable(docs.sparkSession)
    prints = written(fingerprints(docs, shingle))
    least = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "_row")).alias("least"))
    roots = connected_components(near_links(least.select("fp"), bits, hot)).withColumnRenamed("u", "fp")
    tied = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    top = tied.groupBy("root").agg(F.min("least").alias("top"))
    return prints, tied.select("fp", "root").join(top, "root").select("fp", "top")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``docs``."""
    prints, tops = _groups(docs, shingle, bits, hot)
    return prints.join(tops, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                          F.col("top.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """The row with the smallest doc_id of each group (null ids last, then file order), all columns."""
    prints, tops = _groups(docs, shingle, bits, hot)
    gone = written(prints.join(tops, "fp").where(F.col("_row") != F.col("top._row")).select("_row"))
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)        # the texts stay where they are
    plain, names = plain_names(docs)
    return numbered(plain, *names.values()).join(gone, "_row", "left_anti").select(*names.values()).toDF(*names)
