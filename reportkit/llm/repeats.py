"""Repeated token windows over a whole corpus: the plumbing around an index per shard.

1. Every text is cut into runs of windows with one key (``runs.find_runs``); the rows
   ``(key, content, doc, position)`` are shuffled by key. Runs whose key occurs once
   cannot hold a repeated window and stop here (four of five on the test tables).
2. Runs with equal content are collapsed: one stands for all, the others need no text.
   A copied text has many keys, so a group of copies is spread over many tasks.
3. The text of the standing runs is cut out and shuffled by key into shards of bounded
   size; an index per shard decides which windows occur twice. Keys with very many
   different runs (a common passage in many contexts) are first re-cut into single windows,
   keyed and collapsed by their own hash, so no shard grows with the hottest key.
4. The spans found meet the texts again, one join on the row number.

Nothing is capped or sampled, and no list reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import runs as R
from .common import importable, numbered, written

PIECE = 1 << 19          # tokens looked at together when runs are searched
HOT_RUNS = 50_000        # different runs of one key beyond which they are re-cut
_RUN = "key long, content long, doc_id long, _row long, pos long, n int, own boolean"


def tokens_of(data: bytes, unit: str):
    """(values, starts, ends) of a text's tokens: its bytes, or its words."""
    if unit == "byte":
        return R.byte_values(data), None, None
    if len(data) <= PIECE:
        return R.word_values(data)
    parts, at = [], 0                      # very long texts: piece by piece, cut at white space
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        v, s, e = R.word_values(data[at:end])
        parts.append((v, s + at, e + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts))


def _groups(texts: list, unit: str, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Token values of several short texts, or of a piece of a long one, at a time.

    Yields (values, bounds, text numbers, offset of each in its text).
    """
    vals, nums, offs, size = [], [], [], 0

    def flush():
        bounds = np.cumsum([0] + [len(v) for v in vals])
        return np.concatenate(vals), bounds, np.array(nums), np.array(offs)

    for i, t in enumerate(texts):
        if not t:
            continue
        v = tokens_of(t, unit)[0]
        for at in range(0, max(1, len(v) - width + 1), PIECE):
            piece = v[at:at + PIECE + width - 1]
            if size and size + len(piece) > PIECE:
                yield flush()
                vals, nums, offs, size = [], [], [], 0
            vals.append(piece)
            nums.append(i)
            offs.append(at)
            size += len(piece)
    if size:
        yield flush()


def _binary(column: pa.Array) -> list:
    return column.cast(pa.binary()).to_pylist()


def find_runs(rows: DataFrame, unit: str, width: int, gram: int) -> DataFrame:
    """Rows (_row, doc_id, text) -> one row per run of windows."""

    def search(batches):
        for b in batches:
            ids, row = b.column("doc_id").to_numpy(zero_copy_only=False), b.column("_row").to_numpy()
            missing = np.asarray(b.column("doc_id").is_null())
            ids = np.where(missing, np.iinfo(np.int64).min, np.nan_to_num(ids)).astype(np.int64) \
                if missing.any() else ids.astype(np.int64)
            for values, bounds, num, off in _groups(_binary(b.column("text")), unit, width):
                text, start, n, key, content, own = R.find_runs(values, bounds, width, gram)
                if len(text):
                    at = num[text]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), pa.array(ids[at]),
                         pa.array(row[at]), pa.array(start + off[text]), pa.array(n.astype(np.int32)),
                         pa.array(own)],
                        names=["key", "content", "doc_id", "_row", "pos", "n", "own"])

    return rows.select("_row", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, _RUN)


def repeated_runs(runs: DataFrame) -> DataFrame:
    """Keep runs whose key occurs again; number the occurrences of equal runs (``nth`` = 1: stands for all)."""
    same = Window.partitionBy("key", "content")
    return (runs.repartition("key")
            .withColumn("nth", F.row_number().over(same.orderBy("doc_id", "_row", "pos")))
            .withColumn("copies", F.count(F.lit(1)).over(same))
            .withColumn("uses", F.count(F.lit(1)).over(Window.partitionBy("key")))
            .withColumn("kinds", F.count_if(F.col("nth") == 1).over(Window.partitionBy("key")))
            .where("uses > 1 OR own").drop("uses"))


def _with_text(rows: DataFrame, found: DataFrame) -> DataFrame:
    """One row per text with the list of its runs (bounded by the text's own length)."""
    per = found.groupBy("_row").agg(F.collect_list(F.struct("key", "content", "doc_id", "pos", "n", "copies")).alias("found"))
    return rows.select("_row", "text").join(per, "_row")


_FOUND = ["key", "content", "doc_id", "pos", "n", "copies"]


def _found_arrays(batch: pa.RecordBatch):
    lists = batch.column("found")
    flat = lists.flatten()
    return np.asarray(lists.value_lengths()), {f: flat.field(f).to_numpy() for f in _FOUND}


def cut_segments(with_text: DataFrame, unit: str, width: int) -> DataFrame:
    """The token text of every listed run: ``segment`` holds its bytes (words joined by one space)."""

    def cut(batches):
        for b in batches:
            if not b.num_rows:
                continue
            counts, f = _found_arrays(b)
            rows = np.repeat(b.column("_row").to_numpy(), counts)
            segments, at = [], 0
            for text, c in zip(_binary(b.column("text")), counts):
                if unit == "byte":
                    for p, n in zip(f["pos"][at:at + c].tolist(), f["n"][at:at + c].tolist()):
                        segments.append(text[p:p + n + width - 1])
                else:
                    words = text.split()
                    for p, n in zip(f["pos"][at:at + c].tolist(), f["n"][at:at + c].tolist()):
                        segments.append(b" ".join(words[p:p + n + width - 1]))
                at += c
            yield pa.RecordBatch.from_arrays(
                [pa.array(f["key"]), pa.array(f["doc_id"]), pa.array(rows), pa.array(f["pos"]),
                 pa.array(f["n"].astype(np.int32)), pa.array(f["copies"].astype(np.int64)), pa.array(segments, pa.binary())],
                names=["key", "doc_id", "_row", "pos", "n", "copies", "segment"])

    return with_text.mapInArrow(cut, "key long, doc_id long, _row long, pos long, n int, copies long, segment binary")


def single_windows(with_text: DataFrame, unit: str, width: int) -> DataFrame:
    """Re-cut runs of hot keys: one run per window, keyed by the window's own hash."""

    def cut(batches):
        for b in batches:
            if not b.num_rows:
                continue
            counts, f = _found_arrays(b)
            row, at = b.column("_row").to_numpy(), 0
            for i, (text, c) in enumerate(zip(_binary(b.column("text")), counts)):
                prefix = R.prefix_hash(tokens_of(text, unit)[0])
                p, n = f["pos"][at:at + c], f["n"][at:at + c]
                start = np.repeat(p - (np.cumsum(n) - n), n) + np.arange(n.sum())
                h = R.span_hash(prefix, start, start + width).view(np.int64)
                ids = np.repeat(f["doc_id"][at:at + c], n)
                at += c
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(h), pa.array(ids), pa.array(np.full(len(h), row[i])), pa.array(start),
                     pa.array(np.ones(len(h), np.int32)), pa.array(np.zeros(len(h), bool))],
                    names=["key", "content", "doc_id", "_row", "pos", "n", "own"])

    return with_text.mapInArrow(cut, _RUN)


def by_shard(segments: DataFrame, decide: Callable, size: int) -> DataFrame:
    """Shuffle segments by key and hand ``decide`` whole keys, about ``size`` bytes at a time.

    ``decide(list of segments, n, copies, order)`` returns (segment number, first window,
    end window) arrays of the windows to report; the result has token spans per ``_row``.
    """

    def work(batches):
        held, held_size, last = [], 0, None

        def flush():
            t = pa.Table.from_batches(held).combine_chunks()
            col = lambda c: t.column(c).to_numpy()
            pos, rows = col("pos"), col("_row")
            order = np.lexsort((pos, rows, col("doc_id")))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            seg, lo, hi = decide(t.column("segment").to_pylist(), col("n"), col("copies"), rank)
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[seg]), pa.array(pos[seg] + lo), pa.array(pos[seg] + hi)], names=["_row", "lo", "hi"])

        for b in batches:
            if not b.num_rows:
                continue
            key = b.column("key").to_numpy()
            sizes = np.cumsum(np.diff(np.frombuffer(b.column("segment").buffers()[1], np.int32)[b.column("segment").offset:][:b.num_rows + 1]))
            edges = np.concatenate((np.flatnonzero(np.concatenate(([last is not None and key[0] != last], key[1:] != key[:-1]))), [b.num_rows]))
            at = 0
            for e in edges:
                if e > at:
                    held.append(b.slice(at, e - at))
                    held_size += int(sizes[e - 1] - (sizes[at - 1] if at else 0))
                if e < b.num_rows and held_size >= size:
                    yield flush()
                    held, held_size = [], 0
                at = e
            last = key[-1]
        if held:
            yield flush()

    return (segments.repartition("key").sortWithinPartitions("key")
            .mapInArrow(work, "_row long, lo long, hi long"))


def repeat_spans(docs: DataFrame, unit: str, width: int, gram: int, decide: Callable, size: int,
                 keep_first: bool, hot_runs: int = HOT_RUNS) -> DataFrame:
    """Windows to remove, as rows (_row, lo, hi): window starts ``lo`` to ``hi`` (exclusive).

    ``keep_first``: the first of equal windows stays (by doc_id, row, position; a null
    doc_id sorts first); otherwise all of them are reported.
    """
    importable(docs.sparkSession)
    rows = numbered(docs, "doc_id", "text")
    runs = written(repeated_runs(find_runs(rows, unit, width, gram)))
    hot = runs.where(F.col("kinds") > hot_runs)
    cold = runs.where(F.col("kinds") <= hot_runs)
    if not hot.isEmpty():
        # copies of a hot run follow their first one below, so only that one is re-cut
        again = written(repeated_runs(single_windows(_with_text(rows, hot.where("nth = 1")), unit, width)))
        parts = [cold, again]
        copies = [hot.where("copies > 1")]
    else:
        parts, copies = [cold], []
    whole, standing = [], []
    for p in parts:
        whole.append(p.where("nth > 1" if keep_first else "copies > 1"))
        standing.append(p.where("nth = 1"))
    for p in copies:
        whole.append(p.where("nth > 1") if keep_first else p)
    spans = [w.select("_row", F.col("pos").alias("lo"), (F.col("pos") + F.col("n")).alias("hi")) for w in whole]
    stand = standing[0]
    for s in standing[1:]:
        stand = stand.unionByName(s)
    out = by_shard(cut_segments(_with_text(rows, stand), unit, width), decide, size)
    for s in spans:
        out = out.unionByName(s)
    return out


def removed_tokens(lo: np.ndarray, hi: np.ndarray, width: int, total: int) -> np.ndarray:
    """Mask of the tokens covered by windows starting in ``[lo, hi)``."""
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, lo, 1)
    np.add.at(edge, np.minimum(hi - 1 + width, total), -1)
    return np.cumsum(edge[:-1]) > 0


def apply_spans(docs: DataFrame, spans: DataFrame, finish: Callable, schema: str, *extra: str) -> DataFrame:
    """Join the spans to the texts and let ``finish(text bytes, lo, hi)`` make each row's result.

    ``finish`` returns the values of the columns that ``schema`` adds to doc_id and ``extra``.
    """
    per = spans.groupBy("_row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    rows = numbered(docs, "doc_id", *extra, *([] if "text" in extra else ["text"])).join(per, "_row", "left")
    keep = ["doc_id", *extra]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    names = [c.split()[0] for c in schema.split(", ")]
    full = ", ".join([f"`{c}` {kinds[c]}" for c in keep if c not in names] + [schema])
    keep = [c for c in keep if c not in names]
    types = pa.schema([pa.field(n, {"long": pa.int64(), "string": pa.string()}[c.split()[1]]) for n, c in zip(names, schema.split(", "))])

    def work(batches):
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column("spans")
            counts = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(int)
            flat = lists.flatten()
            lo, hi = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
            made, at = [], 0
            for text, c in zip(_binary(b.column("text")), counts):
                made.append(finish(text or b"", lo[at:at + c], hi[at:at + c], text is None))
                at += c
            cols = list(zip(*made))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(c, types.field(i).type) for i, c in enumerate(cols)],
                names=keep + names)

    return rows.mapInArrow(work, full)
