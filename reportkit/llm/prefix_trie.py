"""Conversation prefix trie: which openings conversations share, as one row per trie node.

Method (burst trie): every turn gets an id (digest of role and text, with the text's length behind it), so a conversation is a
string of ids. All conversations start in one container under the root. A container with more than ``CAP`` different suffixes
is burst: its head becomes a node of the trie's top and its suffixes move, by their next turn id, to containers one turn
deeper; that repeats until no container is too big. The remaining containers are dealt to shards by their head, sorted, and
swept: neighbouring suffixes share a prefix, and one stack of open nodes gives every node's figures in one walk.

Nothing holds a whole group. Equal suffixes are one row per ``CHUNK`` conversation ids, with a count, so a group of copies
shrinks before it is shuffled. Conversations are cut into pieces of ``PIECE`` turns; a piece hangs under a head of its own (a
digest of the turns before it), so a row never exceeds ``PIECE`` ids and bursting ends after ``PIECE`` rounds. What lies
below a piece's head is added to the nodes above it by running sums along the conversations: every node belongs to its
smallest member, so nothing is counted twice. Turns are numbered in two levels (ranges of turn numbers, then rows).

Defined cases: null conv_id: not a conversation, left out; null turn: before the others; null role or text: empty; rows of one
conversation with one turn number: ordered by turn id (repeated rows are turns like others); conversation without turns: ends at
the root; very long texts count with all their code points, very long conversations with all their turns; empty table: no rows, not
even a root; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportkit.operators.windows import seq_number, seq_running_sum

from .common import importable, written

PIECE, CAP, CHUNK = 64, 512, 4096
ID = 20                                # bytes: digest of role and text, then the text's length
TURNS, BUCKET = 1024, 1024             # turn numbers / pieces of a conversation that one task orders
_EMPTY = hashlib.sha256(b"").hexdigest()
_ROOT = b"\0"


def turn_id(role: Column, text: Column) -> Column:
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.length(text).cast("long")), 8, "0")))


def numbered_turns(told: DataFrame) -> DataFrame:
    """conv_id, d = 1, 2, ..., id of every row with a conversation."""
    rows = told.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_turn"),
        turn_id(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))).alias("id"))
    return seq_number(rows, ["conv_id"], ["_turn", "id"], "d", F.floor(F.col("_turn") / TURNS)).select(
        "conv_id", F.col("d").cast("long").alias("d"), "id")


def rebuilt(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Conversations that open like the first of their hundred: the first h turns of conversation c - c % group, then c's own
    turns after its first h, with h = crc32(c) % most. Returns conv_id, d, id and a row (conv_id, 0, null) per conversation."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = F.col("conv_id") - F.col("conv_id") % group
    opening = turns.where((F.col("conv_id") % group == 0) & (F.col("d") < most)).select(
        F.col("conv_id").alias("_base"), F.col("d").alias("_d"), F.col("id").alias("_id"))          # at most ``most`` - 1 turns each
    size = opening.groupBy("_base").agg(F.max("_d").alias("_size"))
    convs = turns.select("conv_id").distinct()
    own = turns.where(F.col("d") > h).withColumn("_base", base).join(size, "_base", "left").select(
        "conv_id", (F.col("d") - h + F.least(h, F.coalesce("_size", F.lit(0)))).alias("d"), "id")
    first = convs.withColumn("_base", base).join(opening, "_base").where(F.col("_d") <= h).select(
        "conv_id", F.col("_d").alias("d"), F.col("_id").alias("id"))
    return own.unionByName(first).unionByName(convs.select("conv_id", F.lit(0).cast("long").alias("d"), F.lit(None).cast("binary").alias("id")))


def as_sequences(turns: DataFrame) -> DataFrame:
    """Conversations as they are: conv_id, d, id, and a row (conv_id, 0, null) per conversation."""
    return turns.unionByName(turns.select("conv_id").distinct().select(
        "conv_id", F.lit(0).cast("long").alias("d"), F.lit(None).cast("binary").alias("id")))


def _length(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, ID - 3, 4)), 16, 10).cast("long")


def pieces(seqs: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per conversation and ``piece`` turns: conv_id, k, head, hlen (text length of the head's turn), path (ids end to
    end), last, next_head (of a full piece). The last piece of every conversation is shorter than ``piece``, maybe empty."""
    turn = seqs.where("d > 0")
    k = F.floor((F.col("d") - 1) / piece).cast("long")
    end = seqs.groupBy("conv_id").agg(F.floor(F.max("d") / piece).cast("long").alias("k")).select(
        "conv_id", "k", F.lit(None).cast("long").alias("d"), F.lit(None).cast("string").alias("id"),
        F.lit(None).cast("long").alias("hlen"), F.lit(True).alias("last"))
    told = turn.select("conv_id", k.alias("k"), "d", F.hex("id").alias("id"), F.lit(None).cast("long").alias("hlen"), F.lit(False).alias("last"))
    over = turn.where(F.col("d") % piece == 0).select("conv_id", (k + 1).alias("k"), F.lit(None).cast("long").alias("d"),
                                                      F.lit(None).cast("string").alias("id"), _length(F.col("id")).alias("hlen"),
                                                      F.lit(False).alias("last"))
    order = F.sort_array(F.collect_list(F.when(F.col("d").isNotNull(), F.struct("d", "id"))))       # at most ``piece`` turns
    p = told.unionByName(end).unionByName(over).groupBy("conv_id", "k").agg(
        F.unhex(F.array_join(F.transform(order, lambda s: s["id"]), "")).alias("path"),
        F.coalesce(F.max("hlen"), F.lit(0)).alias("hlen"), F.bool_or("last").alias("last"))
    p = written(p)
    # heads: digests of all turns before, from digests of the pieces, combined in two levels
    marks = [F.xxhash64(F.lit(i), "k", "path") for i in (1, 2)]
    d = p.select("conv_id", "k", F.floor(F.col("k") / BUCKET).alias("_b"), marks[0].alias("_m1"), marks[1].alias("_m2")).where(
        F.length(p["path"]) == ID * piece)
    w = Window.partitionBy("conv_id", "_b").orderBy("k")
    wb = Window.partitionBy("conv_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = d.groupBy("conv_id", "_b").agg(F.bit_xor("_m1").alias("_x1"), F.bit_xor("_m2").alias("_x2"))
    before = before.select("conv_id", "_b", *[F.coalesce(F.bit_xor(x).over(wb), F.lit(0).cast("long")).alias(f"_o{x}") for x in ("_x1", "_x2")])
    d = d.withColumns({"_r1": F.bit_xor("_m1").over(w), "_r2": F.bit_xor("_m2").over(w)}).join(before, ["conv_id", "_b"]).select(
        "conv_id", F.col("k").alias("_k"), *[F.col(f"_r{i}").bitwiseXOR(F.col(f"_o_x{i}")).alias(f"_h{i}") for i in (1, 2)])
    full = d.select("conv_id", "_k", F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in (F.col("_k") + 1, "_h1", "_h2")])).alias("next_head"))
    heads = full.select("conv_id", (F.col("_k") + 1).alias("k"), F.col("next_head").alias("head"))
    p = p.join(full.withColumnRenamed("_k", "k"), ["conv_id", "k"], "left").join(heads, ["conv_id", "k"], "left")
    return p.withColumn("head", F.coalesce("head", F.lit(_ROOT)))


def collapsed(p: DataFrame, piece: int = PIECE, chunk: int = CHUNK) -> DataFrame:
    """Equal suffixes of one container as one row: n conversations, the smallest is c; ids lists those that end here."""
    block = F.when(F.col("last"), F.floor(F.col("conv_id") / chunk)).otherwise(F.lit(0))
    rows = p.groupBy("head", "path", "last", block.alias("_block")).agg(
        F.first("k").alias("k"), F.first("hlen").alias("hlen"), F.first("next_head").alias("next_head"),
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("c"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("last"), F.col("conv_id")))), ",").alias("ids")).drop("_block")
    return rows.withColumns({"hd": F.col("k") * piece, "pconv": F.lit(None).cast("long"), "anc": F.array().cast("array<long>"),
                             "ended": F.lit(False)}).drop("k")


def burst(rows: DataFrame, cap: int = CAP):
    """(rows of the remaining containers, nodes of the trie's top, number of children of those)."""
    final, tops, kids, live = None, None, None, written(rows)
    more = F.length("path") > 0
    while True:
        stats = live.groupBy("head").agg(
            F.count_if(more).alias("_m"), F.sum("n").alias("n"), F.min("c").alias("conv_id"), F.first("hd").alias("hd"),
            F.first("hlen").alias("hlen"), F.first("pconv").alias("pconv"), F.first("anc").alias("anc"))
        big = written(stats.where(F.col("_m") > cap).drop("_m"))
        if big.isEmpty():
            return live if final is None else final.unionByName(live), tops, kids
        j = live.join(big.select("head", F.col("conv_id").alias("_c")), "head", "left")
        stay = j.where(F.col("_c").isNull() | ~more).withColumn("ended", F.col("_c").isNotNull() | F.col("ended")).drop("_c")
        first = F.substring("path", 1, ID)
        moved = written(j.where(F.col("_c").isNotNull() & more).withColumns({
            "_old": F.col("head"), "head": F.unhex(F.sha2(F.concat("head", first), 256)), "hd": F.col("hd") + 1, "hlen": _length(first),
            "pconv": F.col("_c"), "anc": F.concat("anc", F.array("_c")), "path": F.expr(f"substring(path, {ID + 1})")}).drop("_c"))
        many = moved.select("_old", "head").distinct().groupBy(F.col("_old").alias("head")).agg(F.count(F.lit(1)).alias("n_children"))
        final = stay if final is None else final.unionByName(stay)
        tops = big if tops is None else tops.unionByName(big)
        kids = many if kids is None else kids.unionByName(many)
        live = moved.drop("_old").select(*rows.columns)


_NODE = pa.schema([("kind", pa.int32()), ("head", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("pconv", pa.int64()),
                   ("n", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("own", pa.int64()),
                   ("sha", pa.string()), ("anc", pa.list_(pa.int64()))])
_NODE_DDL = ("kind int, head binary, conv_id long, depth long, pconv long, n long, n_children long, n_leaves long, saved long, own long, "
             "sha string, anc array<long>")
_SWEPT = ["head", "path", "c", "last", "ended", "hd", "hlen", "pconv", "anc", "next_head", "n", "ids", "leaves_below", "saved_below"]
NODE, ENDS, LINK = 0, 1, 2


class _Open:
    """A node whose subtree is still being read."""
    __slots__ = ("c", "n", "length", "children", "leaves", "saved", "sha", "below", "links")

    def __init__(self, length):
        self.c, self.n, self.length, self.children, self.leaves, self.saved = None, 0, length, 0, 0, 0
        self.sha, self.below, self.links = None, [], []

    def add(self, c, n):
        self.c = c if self.c is None else min(self.c, c)
        self.n += n


def sweep(batches):
    """Walk containers sorted by head, path and smallest member; emits their nodes, and what lies at their edges."""
    done: list = []
    stack: list[_Open] = []
    path, at = b"", None                # of the row before; (head, depth, parent, ancestors) of the container

    def close(depth):
        while len(stack) > depth:
            x = stack.pop()
            own = (x.n - 1) * x.length
            x.leaves += x.children == 0
            x.saved += own
            done.extend((*row[:4], x.c, *row[5:]) for row in x.below)
            done.extend((LINK, head, None, None, x.c, 0, 0, 0, 0, 0, None, []) for head in x.links)
            head, base, parent, anc = at
            inner = len(stack) > 0
            row = (NODE, None if inner else head, x.c, base + len(stack), None if inner else parent, x.n, x.children, x.leaves, x.saved, own,
                   x.sha.hexdigest() if x.sha else _EMPTY, [] if inner else anc)
            if inner:
                up = stack[-1]
                up.add(x.c, x.n)
                up.children += 1
                up.leaves += x.leaves
                up.saved += x.saved
                up.below.append(row)
            else:
                done.append(row)

    def flush():
        cols = list(zip(*done))
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _NODE.types)], schema=_NODE)
        done.clear()
        return batch

    ends = None                         # (head, digest) of conversations that end at a burst head
    for b in batches:
        for head, p, c, last, ended, hd, hlen, pconv, anc, next_head, n, ids, leaves, saved in zip(*(b.column(x).to_pylist() for x in _SWEPT)):
            if at is None or head != at[0]:
                close(0)
                if ends:
                    done.append((ENDS, ends[0], None, None, None, 0, 0, 0, 0, 0, ends[1].hexdigest(), []))
                    ends = None
                at, path = (head, hd, pconv, anc), b""
                if len(done) > 20_000:
                    yield flush()
            if ended:
                if ends is None:
                    ends = (head, hashlib.sha256(ids.encode()))
                else:
                    ends[1].update(b"," + ids.encode())
                continue
            if not last and not p:      # the container is the next piece's head itself
                done.append((LINK, next_head, None, hd, pconv, 0, 0, leaves, saved, 0, None, anc))
                continue
            turns = len(p) // ID - (not last)
            if not stack:
                stack.append(_Open(hlen))
            same = 0
            while same < min(turns, len(stack) - 1) and p[same * ID:same * ID + ID] == path[same * ID:same * ID + ID]:
                same += 1
            close(same + 1)
            for i in range(same, turns):
                stack.append(_Open(int.from_bytes(p[i * ID + ID - 4:i * ID + ID], "big")))
            x = stack[-1]
            x.add(c, n)
            if last:
                if x.sha is None:
                    x.sha = hashlib.sha256(ids.encode())
                else:
                    x.sha.update(b"," + ids.encode())
            else:
                x.children += 1
                x.leaves += leaves
                x.saved += saved
                x.links.append(next_head)
            path = p
    close(0)
    if ends:
        done.append((ENDS, ends[0], None, None, None, 0, 0, 0, 0, 0, ends[1].hexdigest(), []))
    if done:
        yield flush()


def _swept(rows: DataFrame) -> DataFrame:
    return (rows.select(*_SWEPT).repartition("head").sortWithinPartitions("head", "path", "c")
            .mapInArrow(sweep, _NODE_DDL))


def _below(deep: DataFrame, rows: DataFrame, tops: DataFrame | None, piece: int) -> DataFrame:
    """head, leaves_below, saved_below of every head of a later piece: sums over its whole subtree."""
    none = F.lit(0).cast("long")
    nodes = _swept(rows.where(F.col("hd") >= piece).withColumns({"leaves_below": none, "saved_below": none})).where(F.col("kind") == NODE)
    own = nodes.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("leaf"), "own")
    if tops is not None:
        own = own.unionByName(tops.where(F.col("hd") >= piece).select(
            "conv_id", F.col("hd").alias("depth"), none.alias("leaf"), ((F.col("n") - 1) * F.col("hlen")).alias("own")))
    own = own.groupBy("conv_id", F.floor(F.col("depth") / piece).cast("long").alias("k")).agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    d = deep.join(own, ["conv_id", "k"], "left").fillna(0, ["leaf", "own"]).withColumn("_back", -F.col("k"))
    for c, out in (("leaf", "leaves_below"), ("own", "saved_below")):
        d = seq_running_sum(d, ["conv_id"], ["_back"], c, out, F.floor(F.col("_back") / BUCKET))
    return d.groupBy("head").agg(F.sum("leaves_below").alias("leaves_below"), F.sum("saved_below").alias("saved_below"))


def trie(seqs: DataFrame, piece: int = PIECE, cap: int = CAP, chunk: int = CHUNK) -> DataFrame:
    """Nodes of the trie of ``seqs`` (conv_id, d, id; a row with d = 0 per conversation): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    importable(seqs.sparkSession)
    p = written(pieces(seqs, piece))
    rows, tops, kids = burst(collapsed(p, piece, chunk), cap)
    deep = p.where("k > 0").select("conv_id", "k", "head")
    long_ones = not deep.isEmpty()
    none = F.lit(0).cast("long")
    if long_ones:
        below = _below(deep, rows, tops, piece)
        rows = rows.join(below.withColumnRenamed("head", "next_head"), "next_head", "left").fillna(0, ["leaves_below", "saved_below"])
    else:
        rows = rows.withColumns({"leaves_below": none, "saved_below": none})
    made = written(_swept(rows))
    nodes = made.where(F.col("kind") == NODE).select("conv_id", "depth", "pconv", "n", "n_children", "n_leaves", "saved", "sha", "head")
    if tops is not None:
        # what containers and heads below hold, for every head above them in the piece
        up = made.where((F.size("anc") > 0) & (F.col("kind") != ENDS)).select("anc", (F.col("depth") - F.size("anc")).alias("_at"), "n_leaves", "saved")
        own = tops.select(F.concat("anc", F.array("conv_id")).alias("anc"), (F.col("hd") - F.size("anc")).alias("_at"),
                          none.alias("n_leaves"), ((F.col("n") - 1) * F.col("hlen")).alias("saved"))
        sums = up.unionByName(own).select("*", F.posexplode("anc").alias("_i", "conv_id")).groupBy(
            "conv_id", (F.col("_at") + F.col("_i")).alias("depth")).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
        ends = made.where(F.col("kind") == ENDS).select("head", "sha")
        top = (tops.select("head", "conv_id", F.col("hd").alias("depth"), "pconv", "n").join(kids, "head").join(sums, ["conv_id", "depth"])
               .join(ends, "head", "left").withColumn("sha", F.coalesce("sha", F.lit(_EMPTY))))
        nodes = nodes.unionByName(top.select(*nodes.columns))
    if long_ones:
        links = made.where(F.col("kind") == LINK).select("head", F.col("pconv").alias("_link"))
        nodes = nodes.join(links, "head", "left").withColumn("pconv", F.coalesce("_link", "pconv"))
    return nodes.select("conv_id", "depth", F.col("pconv").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves",
                        F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"))


def oracle_sql() -> str:
    """DuckDB SQL of ``trie(rebuilt(...))``: prefixes spelled out, members joined."""
    from .resample import CRC_TABLE, crc_sql
    return f"""
        WITH crc AS ({CRC_TABLE}),
        own AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS d
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base, {crc_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM own) CROSS JOIN crc),
        size AS (SELECT conv_id AS base, max(d) AS size FROM own GROUP BY conv_id),
        told AS (
            SELECT c.conv_id, o.d, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.d <= c.h
            UNION ALL
            SELECT c.conv_id, o.d - c.h + least(c.h, coalesce(s.size, 0)), o.role, o.text
            FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.d > c.h LEFT JOIN size s ON s.base = c.base),
        marked AS (
            SELECT conv_id, 0 AS d, 0 AS len, 'root' AS path FROM convs
            UNION ALL
            SELECT conv_id, d, length(text), string_agg(sha256(length(role) || ':' || role || text), '/') OVER (
                PARTITION BY conv_id ORDER BY d) FROM told),
        node AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, any_value(len) AS len FROM marked GROUP BY path, d),
        up AS (
            SELECT n.path, n.d, p.path AS parent, p.conv_id AS parent_conv_id
            FROM node n JOIN marked m ON m.conv_id = n.conv_id AND m.d = n.d - 1 JOIN node p ON p.path = m.path AND p.d = m.d),
        kids AS (SELECT parent AS path, d - 1 AS d, count(*) AS n_children FROM up GROUP BY parent, d),
        facts AS (
            SELECT node.path, node.d, node.conv_id, CAST(coalesce(n_children, 0) = 0 AS BIGINT) AS leaf, (n - 1) * len AS saved
            FROM node LEFT JOIN kids USING (path, d)),
        sums AS (        -- every node lies below the prefixes of its smallest member
            SELECT a.path, a.d, sum(f.leaf) AS n_leaves, sum(f.saved) AS saved
            FROM facts f JOIN marked a ON a.conv_id = f.conv_id AND a.d <= f.d GROUP BY a.path, a.d),
        ends AS (
            SELECT path, d, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
            FROM marked JOIN (SELECT conv_id, max(d) AS d FROM marked GROUP BY conv_id) USING (conv_id, d) GROUP BY path, d)
        SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, up.parent_conv_id, n.n AS n_convs, coalesce(n_children, 0) AS n_children,
               CAST(n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM node n JOIN sums s USING (path, d) LEFT JOIN up USING (path, d) LEFT JOIN kids USING (path, d) LEFT JOIN ends USING (path, d)"""
