"""Mixing sources to target weights by iterative proportional fitting (raking).

Method: documents are summed into cells (source, language, topic) with their words. The cell weights are
raked: in turn, each margin's weights are scaled to its target shares, until a whole round moves no cell by
more than ``tolerance``. A document's expected copies are the budget times its cell's weight per word; it is
drawn ``floor(expected + u)`` times, where u is a uniform number made from its id and text, so a run can be
repeated and expected words per source, language and topic meet the targets.

Only cell tables are shuffled in the rounds, every margin is summed up before its shuffle, and every round is
written to the shared folder. Texts never move. Cells are broadcast to the documents only after they are
counted (``BROADCAST_CELLS``). Everything is DataFrame code.

Targets: a table (value, share) per margin, or a number: shares proportional to the words to that power (1 keeps
the mix, 0 makes all values equal). Shares are taken among values that have words.

Defined cases: null source, language or topic: a value of its own; null text: no words; documents without words get
weight 1 and, as any other, expected copies = budget; a value without a target keeps no documents; a target
without documents is left out; margins that no weights can meet together: the last round counts; repeated rows:
drawn alike; empty table: no rows; input columns named like the five that are added: replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_WORD, drop_written, plain_names, written

TEMPERATURE = 0.7
TOLERANCE = 1e-4
ROUNDS = 100
ADDED = ["mix_topic", "mix_words", "mix_weight", "mix_expected", "mix_copies"]
BROADCAST_CELLS = 100_000


def topic_of(text: Column) -> Column:
    """Kind of text by its signs and length: tabular, symbolic, brief or prose."""
    size = F.length(text)
    bars = size - F.length(F.replace(text, F.lit("|"), F.lit("")))
    signs = size - F.length(F.translate(text, "#*$%&<>", ""))
    return (F.when(F.coalesce(size, F.lit(0)) == 0, "brief").when(bars * 25 > size, "tabular").when(signs * 25 > size, "symbolic")
            .when(size < 300, "brief").otherwise("prose"))


def _key(c: str) -> Column:
    return F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n"))


def _target(cells: DataFrame, margin: str, target) -> DataFrame:
    """(margin, share) over the values that have words; the shares add up to 1."""
    words = cells.groupBy(margin).agg(F.sum("words").alias("w")).where("w > 0")
    if isinstance(target, DataFrame):
        given = target.select(F.coalesce(F.concat(F.lit("v"), F.col("value").cast("string")), F.lit("n")).alias(margin),
                              F.col("share").cast("double").alias("share"))
        shares = words.join(given, margin, "left").select(margin, F.coalesce("share", F.lit(0.0)).alias("share"))
    else:
        shares = words.select(margin, F.pow(F.col("w"), F.lit(float(target))).alias("share"))
    total = shares.agg(F.sum("share").alias("total"))      # one row
    return shares.join(F.broadcast(total)).select(margin, (F.col("share") / F.col("total")).alias("share"))


def rake(cells: DataFrame, targets: dict, tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> DataFrame:
    """(margins..., words) -> the same with ``fitted``, the share of all words that the cell should have."""
    aims = {m: written(_target(cells, m, t)) for m, t in targets.items()}
    total = cells.agg(F.sum("words")).first()[0] or 0      # one number
    now = written(cells.withColumns({"fitted": F.col("words") / F.lit(float(max(total, 1))), "moved": F.lit(1.0)}))
    for _ in range(rounds):
        step = now.withColumn("moved", F.lit(0.0))
        for m, aim in aims.items():
            have = step.groupBy(m).agg(F.sum("fitted").alias("have"))
            factor = have.join(aim, m, "left").select(
                m, F.when(F.col("have") > 0, F.coalesce("share", F.lit(0.0)) / F.col("have")).otherwise(F.lit(1.0)).alias("factor"))
            step = step.join(factor, m).withColumns({
                "fitted": F.col("fitted") * F.col("factor"),
                "moved": F.when(F.col("fitted") > 0, F.greatest("moved", F.abs(F.col("factor") - 1))).otherwise(F.col("moved")),
            }).drop("factor")
        step = written(step.select(now.columns))
        drop_written(now)
        now = step
        if (now.agg(F.max("moved")).first()[0] or 0.0) <= tolerance:
            break
    return now.drop("moved")


def mix(docs: DataFrame, targets: dict | None = None, budget: float = 1.0, topic: Column | None = None, seed: int = 42,
        tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` plus mix_topic, mix_words, mix_weight (wanted over present words of its cell), mix_expected and mix_copies.

    ``targets``: margin -> table (value, share) or power, for source, lang and topic. ``budget``: words to draw, as a
    share of all words.
    """
    targets = {"source": TEMPERATURE, "lang": TEMPERATURE, "topic": TEMPERATURE} | (targets or {})
    docs = docs.drop(*ADDED)
    topic = topic_of(F.col("text")) if topic is None else topic
    docs = docs.withColumns({"mix_topic": topic, "mix_words": F.regexp_count(F.coalesce("text", F.lit("")), F.lit(SPACE_WORD)).cast("long")})
    plain, names = plain_names(docs)
    margin = {"source": "_source", "lang": "_lang", "topic": "_topic"}
    keyed = plain.withColumns({"_source": _key(names["source"]), "_lang": _key(names["lang"]), "_topic": _key(names["mix_topic"])})
    margins, words = list(margin.values()), names["mix_words"]
    cells = written(keyed.groupBy(*margins).agg(F.sum(words).alias("words")))
    fitted = rake(cells, {margin[m]: t for m, t in targets.items()}, tolerance, rounds)
    total = cells.agg(F.sum("words")).first()[0] or 0
    weights = fitted.select(*margins, F.when(F.col("words") > 0, F.col("fitted") * F.lit(float(total)) / F.col("words"))
                            .otherwise(F.lit(1.0)).alias("mix_weight"))
    if weights.count() <= BROADCAST_CELLS:
        weights = F.broadcast(weights)
    u = F.pmod(F.xxhash64(F.lit(seed), names["doc_id"], names["text"]), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))
    expected = F.col("mix_weight") * F.lit(float(budget))
    return keyed.join(weights, margins).select(
        *names.values(), "mix_weight", expected.alias("mix_expected"), F.floor(expected + u).cast("long").alias("mix_copies")) \
        .toDF(*names, *ADDED[2:])
