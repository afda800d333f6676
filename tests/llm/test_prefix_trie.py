"""The prefix trie against a plain enumeration of all prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from reportkit.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[conv].append((turn is not None, turn or 0, digest, role, text))
    return {c: [(r[3], r[4]) for r in sorted(v)] for c, v in convs.items()}


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def plain(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, m in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += (len(m) - 1) * (len(path[-1][1]) if path else 0)
    return sorted((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


def rows_of(df):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in df.collect())


def told(seed, n=60):
    rng, rows = random.Random(seed), []
    for c in range(n):
        length = rng.choice([1, 2, 3, 4, 6, 7, 13, 20])
        rows += [(c * 7, t, rng.choice(["user", "assistant"]), rng.choice(["", "a", "é" * 3, "long text"])) for t in range(length)]
    same = [(t, "user", f"t{t % 3}") for t in range(12)]
    for c in range(1000, 1030):                         # a group of copies, some going on for a while
        rows += [(c, *s) for s in same] + [(c, 12 + t, "user", "tail") for t in range(c % 4)]
    return rows


@pytest.mark.parametrize("piece,cap,chunk", [(64, 512, 4096), (64, 3, 5), (4, 512, 4096), (4, 2, 3), (1, 1, 2)])
def test_every_setting_gives_the_plain_trie(spark, piece, cap, chunk):
    rows = told(piece * 100 + cap)
    turns = pt.numbered_turns(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = rows_of(pt.trie(pt.written(pt.as_sequences(turns)), piece, cap, chunk))
    assert got == plain(sequences(rows))


def test_rebuilt_conversations(spark):
    rng = random.Random(5)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c // 100}-{rng.randrange(3)}")
            for c in [*range(0, 40), *range(200, 210), *range(301, 320), -7, -205] for t in range(rng.randrange(1, 9))]
    turns = pt.written(pt.numbered_turns(spark.createDataFrame(rows, SCHEMA)))
    convs = sequences(rows)
    fixed = {c: convs.get(c - int(c % 100 if c >= 0 else -(-c % 100)), [])[:zlib.crc32(str(c).encode()) % 6]
             + t[zlib.crc32(str(c).encode()) % 6:] for c, t in convs.items()}
    assert rows_of(pt.trie(pt.rebuilt(turns), cap=4)) == plain(fixed)
    positive = {c: t for c, t in convs.items() if c >= 0}
    assert {c: t for c, t in fixed.items() if c >= 0} == rebuild(positive)


def test_odd_rows(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (None, 0, "user", "x"),
            (2, 5, "user", "é" * 70_000), (3, 5, "user", "é" * 70_000), (4, 1, "us", "er:x"), (5, 1, "user", ":x"), (6, 0, "", "")]
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], SCHEMA + ", depth int, path string")
    assert rows_of(pt.trie(pt.as_sequences(pt.numbered_turns(df)))) == plain(sequences(rows))


def test_one_conversation_holds_most_rows(spark):
    rows = [(1, t, "user", "ab" if t % 5 else "c") for t in range(3000)] + [(2, t, "user", "ab" if t % 5 else "c") for t in range(2500)]
    rows += [(3, 0, "user", "c")]
    got = rows_of(pt.trie(pt.as_sequences(pt.numbered_turns(spark.createDataFrame(rows, SCHEMA)))))
    lengths = [0, *[1 if t % 5 == 0 else 2 for t in range(3000)]]
    assert len(got) == 3001 and got[0][:6] == (1, 0, None, 3, 1, 1) and got[0][6] == 1 + sum(lengths[1:2501])
    assert {r[1]: r[6] for r in got}[2000] == sum(lengths[2000:2501])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows_of(pt.trie(pt.as_sequences(pt.numbered_turns(empty)))) == []
    assert rows_of(pt.trie(pt.rebuilt(pt.numbered_turns(empty)))) == []
