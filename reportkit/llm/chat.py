"""Chat formatting: reply trees -> root-to-leaf branches -> one formatted conversation each.

Method: branches are listed by iterative self-joins. A jump table leads from a node to its 2**k-th
ancestor; joining the table with itself doubles the step, joining the listed branch nodes with it
doubles every branch, so depth d takes log2(d) rounds. Branches are ranked by the sum of their
nodes' scores (ties: smaller leaf) and the best ``branches`` of a tree are formatted.

Template (control strings are fixed; ``\\``, ``[``, ``<`` and ``>`` inside roles and texts are written
``\\0 \\1 \\2 \\3``, so no text can hold a control string and reading back is exact)::

    user        <s>[INST] text [/INST]
    assistant   [OUT] text </s>
    other role  <<role>> text <</>>

Everything is DataFrame code.

Defined cases: null text or role: empty; null tree id: a tree of its own; null score: 0; a parent that
does not exist: the node is a root; a node id given twice in one tree: the least (parent, role, text)
counts; nodes on or below a cycle have no root and are left out; empty table: no rows; other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_written, written

# fixed values: control strings and escape codes
USER, USER_END = "<s>[INST] ", " [/INST]"
ASSISTANT, ASSISTANT_END = "[OUT] ", " </s>"
OTHER, OTHER_MID, OTHER_END = "<<", ">> ", " <</>>"
CODES = (("\\", "\\0"), ("[", "\\1"), ("<", "\\2"), (">", "\\3"))
TURN = r"(<s>\[INST\] |\[OUT\] |<<([^<>\[]*)>> )([^<>\[]*)(?: \[/INST\]| </s>| <</>>)"


def escape(c: Column) -> Column:
    return reduce(lambda x, code: F.replace(x, F.lit(code[0]), F.lit(code[1])), CODES, c)


def unescape(c: Column) -> Column:
    return reduce(lambda x, code: F.replace(x, F.lit(code[1]), F.lit(code[0])), reversed(CODES), c)


def branches_of(nodes: DataFrame) -> DataFrame:
    """(_tree, node, parent) -> (_tree, leaf, node, up): every node of every root-to-leaf branch."""
    links = (nodes.where("parent IS NOT NULL")
             .join(nodes.select("_tree", F.col("node").alias("parent")), ["_tree", "parent"], "left_semi")
             .select("_tree", "node", F.col("parent").alias("anc")))
    jump = written(links)
    leaves = written(nodes.select("_tree", "node")
                     .join(jump.select("_tree", F.col("anc").alias("node")), ["_tree", "node"], "left_anti"))
    longest = nodes.groupBy("_tree").count().agg(F.max("count")).first()[0] or 0
    parts = [leaves.select("_tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))]
    step = 1
    while step <= longest and not jump.isEmpty():
        known = reduce(DataFrame.unionByName, parts)
        parts.append(written(known.join(jump, ["_tree", "node"])
                             .select("_tree", "leaf", F.col("anc").alias("node"), (F.col("up") + step).alias("up"))))
        far = jump.select("_tree", F.col("node").alias("anc"), F.col("anc").alias("far"))
        nxt = written(jump.join(far, ["_tree", "anc"]).select("_tree", "node", F.col("far").alias("anc")))
        drop_written(jump)
        jump, step = nxt, step * 2
    # a node that still has an ancestor after more steps than its tree has nodes is under a cycle
    endless = jump.select("_tree", F.col("node").alias("leaf"))
    return reduce(DataFrame.unionByName, parts).join(endless, ["_tree", "leaf"], "left_anti")


def format_trees(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, node, parent, role, text, score) -> tree, leaf, rank, formatted, loss_spans.

    ``loss_spans``: (start, end) code points of ``formatted`` that hold assistant text (the loss mask).
    """
    nodes = written(
        nodes.withColumn("_tree", F.coalesce(F.concat(F.lit("v"), F.col("tree").cast("string")), F.lit("n")))
        .groupBy("_tree", "node").agg(F.min(F.struct("parent", "role", "text", "score", "tree")).alias("n"))
        .select("_tree", "node", "n.*"))
    paths = branches_of(nodes.select("_tree", "node", "parent"))
    score = paths.join(nodes.select("_tree", "node", "score"), ["_tree", "node"]) \
        .groupBy("_tree", "leaf").agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("score"))
    best = Window.partitionBy("_tree").orderBy(F.desc("score"), "leaf")
    chosen = score.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    role, text = F.coalesce("role", F.lit("")), escape(F.coalesce("text", F.lit("")))
    start = F.when(role == "user", F.lit(USER)).when(role == "assistant", F.lit(ASSISTANT)) \
        .otherwise(F.concat(F.lit(OTHER), escape(role), F.lit(OTHER_MID)))
    end = F.when(role == "user", F.lit(USER_END)).when(role == "assistant", F.lit(ASSISTANT_END)).otherwise(F.lit(OTHER_END))
    so_far = Window.partitionBy("_tree", "leaf").orderBy(F.desc("up"))
    turns = (paths.join(chosen.select("_tree", "leaf", "rank"), ["_tree", "leaf"])
             .join(nodes.select("_tree", "node", "tree", "role", "text"), ["_tree", "node"])
             .select("_tree", "leaf", "up", "rank", "tree", (role == "assistant").alias("loss"),
                     start.alias("start"), text.alias("body"), end.alias("end"))
             .withColumn("piece", F.concat("start", "body", "end"))
             .withColumn("at", F.sum(F.length("piece")).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
                         - F.length("piece") + F.length("start"))
             .withColumn("span", F.when(F.col("loss"), F.struct(F.col("at").alias("start"),
                                                                (F.col("at") + F.length("body")).alias("end")))))
    return (turns.groupBy("_tree", "leaf")
            .agg(F.min("tree").alias("tree"), F.min("rank").alias("rank"),
                 F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("n"), "piece"))).alias("pieces"),
                 F.array_sort(F.collect_list("span")).alias("loss_spans"))
            .select("tree", "leaf", "rank", F.array_join(F.col("pieces.piece"), "").alias("formatted"), "loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse ``formatted`` again: adds turns (role, text) and loss_text (what the mask covers, unescaped)."""
    f = F.col("formatted")
    opened, roles, texts = (F.regexp_extract_all(f, F.lit(TURN), F.lit(g)) for g in (1, 2, 3))
    turn = F.transform(F.arrays_zip(opened.alias("o"), roles.alias("r"), texts.alias("t")), lambda x: F.struct(
        F.when(x["o"] == USER, F.lit("user")).when(x["o"] == ASSISTANT, F.lit("assistant"))
        .otherwise(unescape(x["r"])).alias("role"), unescape(x["t"]).alias("text")))
    # four bytes a code point: a span is cut out in its own length, wherever it stands
    wide = F.encode(f, "UTF-32")
    under = F.transform("loss_spans", lambda s: unescape(F.decode(F.substr(
        wide, (s["start"] * 4 + 1).cast("int"), ((s["end"] - s["start"]) * 4).cast("int")), "UTF-32")))
    return formatted.withColumns({"turns": turn, "loss_text": F.array_join(under, "")})


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """Rows by turn as reply trees: each row answers the one before (ties: role, then text)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    n = F.row_number().over(order).cast("long")
    return conversations.select(F.col("conv_id").alias("tree"), n.alias("node"), "role", "text",
                                F.lit(0.0).alias("score")) \
        .withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the output."""
    back = read_back(formatted)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
