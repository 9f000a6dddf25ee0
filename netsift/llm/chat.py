"""Chat formatting of reply trees, with DataFrame operations only.

A message names the message it answers. Iterative self-joins double the known ancestor of
every message (1, 2, 4, ... steps up) until all have met their root, summing depth and
score on the way; leaves are then the ends of branches. Branches are ranked by score
within their root, and the chosen ones are expanded with the same jump tables from the
longest jump to the shortest: each round doubles a branch's known messages, so a branch of
n messages takes log2(n) joins of narrow rows. Texts join last, once per branch.

*Template.* A turn is ``<|role|>`` + text + ``</s>``; conversations have no other marks.
Inside roles and texts every backslash, ``<``, ``[`` and ``|`` is written as a backslash
and a letter, so no control string, this template's or another's (``[INST]``,
``<|im_start|>``, ``<<SYS>>``), can stand in a text, and the escape is undone exactly.

*Loss mask.* ``loss``: code point spans (start, end) of the formatted text that hold the
assistant texts, between the role mark and the end mark.

Edge cases: a null text is empty and a null role is the empty role; a parent that is
missing, or not before its reply, makes the message a root (so no cycle can arise); rows with the same
conversation and message number are ordered by role and text and all kept when
``linear`` builds the tree; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import persisted

OPEN, CLOSE, END = "<|", "|>", "</s>"
# fixed values of this template: the backslash is escaped first and undone last, so that
# an escaped backslash never starts another escape
ESCAPES = [("\\", "\\e"), ("<", "\\l"), ("[", "\\b"), ("|", "\\p")]
ASSISTANT = "assistant"


def escape(c: Column) -> Column:
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ESCAPES, c)


def unescape(c: Column) -> Column:
    return reduce(lambda x, e: F.replace(x, F.lit(e[1]), F.lit(e[0])), ESCAPES[::-1], c)


def linear(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """A table of turns as reply trees: each turn answers the one before it in its conversation."""
    w = Window.partitionBy("tree").orderBy(F.col("t").asc_nulls_first(), F.col("role"), F.col("text"))
    return (rows.select(F.col(conv).alias("tree"), F.col(turn).alias("t"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
            .withColumn("node", F.row_number().over(w).cast("long"))
            .withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
            .withColumn("score", F.lit(1.0)).select("tree", "node", "parent", "role", "text", "score"))


def jump_tables(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, node, root, depth, total) of every message, and for k = 0, 1, ... the table
    (tree, node, anc) of the messages 2**k steps below ``anc``.

    depth: messages from the root to this one; total: sum of their scores.
    """
    n = nodes.select("tree", "node", "parent", "score")
    up = n.select(F.col("tree").alias("pt"), F.col("node").alias("pn"))
    has = (F.col("tree").eqNullSafe(F.col("pt")) & (F.col("parent") == F.col("pn")) & (F.col("parent") < F.col("node")))
    state = persisted(n.join(up, has, "left")
                      .select("tree", "node", F.col("pn").alias("anc"),
                              F.when(F.col("pn").isNull(), F.col("node")).alias("root"),
                              F.lit(1).cast("long").alias("depth"), F.col("score").cast("double").alias("total")))
    tables = []
    while True:
        open_ = state.filter(F.col("anc").isNotNull())
        if open_.isEmpty():
            return state.drop("anc"), tables
        tables.append(open_.select("tree", "node", "anc"))
        above = state.select(F.col("tree").alias("t2"), F.col("node").alias("n2"), F.col("anc").alias("anc2"),
                             F.col("root").alias("root2"), F.col("depth").alias("d2"), F.col("total").alias("s2"))
        met = (open_.join(above, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("anc") == F.col("n2")))
               .select("tree", "node", F.col("anc2").alias("anc"), F.col("root2").alias("root"),
                       (F.col("depth") + F.col("d2")).alias("depth"), (F.col("total") + F.col("s2")).alias("total")))
        state = persisted(state.filter(F.col("anc").isNull()).unionByName(met))


def branches(nodes: DataFrame, reached: DataFrame, top: int | None) -> DataFrame:
    """(tree, leaf, root, depth, score): ends of branches, the ``top`` of each root by mean
    message score (ties: the earlier leaf); None keeps all."""
    parents = nodes.select(F.col("tree").alias("pt"), F.col("parent").alias("pn")).filter(
        F.col("pn").isNotNull() & (F.col("pn") < F.col("node"))).distinct()
    leaves = (reached.join(parents, F.col("tree").eqNullSafe(F.col("pt")) & (F.col("node") == F.col("pn")), "left_anti")
              .select("tree", F.col("node").alias("leaf"), "root", "depth", (F.col("total") / F.col("depth")).alias("score")))
    if top is None:
        return leaves
    # the best of each of 64 parts first, so that a root with very many branches is no single task
    order = [F.desc("score"), F.asc("leaf")]
    part = Window.partitionBy("tree", "root", F.pmod(F.xxhash64("leaf"), F.lit(64))).orderBy(*order)
    whole = Window.partitionBy("tree", "root").orderBy(*order)
    return (leaves.withColumn("r", F.row_number().over(part)).filter(F.col("r") <= top)
            .withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= top).drop("r"))


def expand(chosen: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """(tree, leaf, node, i): the messages of every chosen branch; i counts from the root."""
    at = persisted(chosen.select("tree", "leaf", F.col("leaf").alias("node"), F.col("depth").alias("i")))
    for k in range(len(tables) - 1, -1, -1):
        jump = tables[k].select(F.col("tree").alias("t2"), F.col("node").alias("n2"), "anc")
        more = (at.join(jump, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("node") == F.col("n2")))
                .select("tree", "leaf", F.col("anc").alias("node"), (F.col("i") - (1 << k)).alias("i")))
        at = persisted(at.unionByName(more))
    return at


def format_trees(nodes: DataFrame, top: int | None = 1) -> DataFrame:
    """One row per chosen branch: tree, leaf, score, n_turns, formatted, loss (spans)."""
    nodes = persisted(nodes.select("tree", "node", "parent", "role", "text", "score"))
    reached, tables = jump_tables(nodes)
    chosen = persisted(branches(nodes, reached, top))
    texts = nodes.select(F.col("tree").alias("t2"), F.col("node").alias("n2"),
                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    mark = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(CLOSE))
    turns = (expand(chosen, tables).join(texts, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("node") == F.col("n2")))
             .select("tree", "leaf", "i", "role", mark.alias("mark"), escape(F.col("text")).alias("body"))
             .withColumn("piece", F.concat("mark", "body", F.lit(END)))
             .withColumn("size", F.length("piece").cast("long")))
    before = Window.partitionBy("tree", "leaf").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0)) + F.length("mark")
    turns = turns.withColumn("start", start)
    span = F.when(F.col("role") == ASSISTANT, F.struct(
        F.col("start"), (F.col("start") + F.length("body")).alias("end")))
    out = (turns.groupBy("tree", "leaf")
           .agg(F.sort_array(F.collect_list(F.struct("i", "piece", span.alias("span")))).alias("turns"))
           .select("tree", "leaf", F.size("turns").cast("long").alias("n_turns"),
                   F.array_join(F.col("turns.piece"), "").alias("formatted"),
                   F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss")))
    rank = chosen.select(F.col("tree").alias("t2"), F.col("leaf").alias("l2"), "score")
    return (out.join(rank, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("leaf") == F.col("l2")))
            .select("tree", "leaf", "score", "n_turns", "formatted", "loss"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    def turn(p: Column) -> Column:
        at = F.locate(CLOSE, p)
        return F.struct(unescape(F.substring(p, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)).alias("role"),
                        unescape(F.substring(p, at + len(CLOSE), F.length(p))).alias("text"))
    pieces = F.split(formatted, END, -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def text_under(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask, spans in order with nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
