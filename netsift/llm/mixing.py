"""Mixing sources to target weights: temperature mixing as budgeted block permutations.

*Weights.* A source's natural share is its part of all tokens (words). Shares are raised
to an exponent and normalised; 1 keeps the natural mix, 0 makes all sources
equal. The exponent is bisected, as near to 1 as the targets allow, until the mix's
entropy reaches ``target_entropy`` (a share of the largest possible) and, with
``max_repetition``, until no source is read more often than that within the budget. The
limit on repetition wins where both cannot hold.

*Realisation.* A source's budget in tokens is its weight times the total budget. Its
documents are read in epochs; each epoch is a permutation by a hash of (seed, epoch,
id), made of blocks: runs of the permutation of about ``block_tokens`` tokens. Whole
epochs take every document; the last takes documents in the order of its permutation
while the tokens before them are below what is left of the budget.

*Schedule.* The blocks of all sources are one permutation: the j-th of a source's m blocks has its
place at (2 j + 1) / (2 m) of the whole schedule (ties by a hash of seed, source, epoch and
block), so any stretch of the schedule holds the sources in proportion to their budgets, and
a source's epochs follow each other. ``turn`` is a block's number in that order.

*Scale.* Tokens of a source are one aggregation; weights are computed on the driver for
one row per source. Running sums over the permutation come from range partitions: sums
within a partition, plus the totals of earlier partitions, so that a hot source is cut
between tasks instead of being one window.

Edge cases: a null or empty text has no tokens and is read in whole epochs, and in the
last one if its place is within the budget; a source without any token is read once; a null source is a source of its own; rows
with the same id and source share their place in the permutation and are ordered by
text; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import persisted

SEED = 17
STEPS = 60
BLOCK_TOKENS = 1 << 16


def count_words(text):
    """Words split by ASCII white space; null counts 0."""
    t = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "), F.lit(" "))
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("long")


def weights(shares: list[float], a: float) -> list[float]:
    """Shares raised to ``a`` and normalised (a share of 0 stays 0)."""
    p = [s ** a if s > 0 else 0.0 for s in shares]
    total = sum(p)
    return [x / total if total else 0.0 for x in p]


def entropy(p: list[float]) -> float:
    return -sum(x * math.log(x) for x in p if x > 0)


def bisect_exponent(shares: list[float], target_entropy: float | None, max_repetition: float | None,
                    budget_share: float = 1.0) -> float:
    """Exponent in [0, 1], to 6 decimals.

    ``target_entropy``: part of the largest entropy to reach, with the largest such exponent.
    ``max_repetition``: the exponent is then raised until weight * budget / share stays within it.
    """
    k = sum(1 for s in shares if s > 0)
    if k < 2:
        return 1.0

    def largest(ok) -> float:
        """The largest exponent that holds, given that smaller ones hold too."""
        if ok(1.0):
            return 1.0
        lo, hi = 0.0, 1.0
        for _ in range(STEPS):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if ok(mid) else (lo, mid)
        return math.floor(lo * 1e6) / 1e6

    a = 1.0
    if target_entropy is not None:
        goal = target_entropy * math.log(k)
        a = largest(lambda x: entropy(weights(shares, x)) >= goal)
    if max_repetition is not None:
        def fits(x: float) -> bool:
            return all(w * budget_share <= max_repetition * s for w, s in zip(weights(shares, x), shares) if s > 0)
        if not fits(a):
            lo, hi = a, 1.0
            for _ in range(STEPS):
                mid = (lo + hi) / 2
                lo, hi = (lo, mid) if fits(mid) else (mid, hi)
            a = min(1.0, math.ceil(hi * 1e6) / 1e6)
    return a


def plan(docs: DataFrame, target_entropy: float | None, max_repetition: float | None,
         budget_share: float) -> list[dict]:
    """Per source: tokens, share, weight and budget in tokens. ``docs``: source, n_tokens."""
    rows = docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).toArrow().to_pylist()  # a row per source
    rows.sort(key=lambda r: (r["source"] is not None, r["source"]))
    total = sum(r["tokens"] for r in rows)
    shares = [r["tokens"] / total if total else 0.0 for r in rows]
    a = bisect_exponent(shares, target_entropy, max_repetition, budget_share)
    for r, s, w in zip(rows, shares, weights(shares, a)):
        r["share"], r["weight"], r["exponent"] = s, round(w, 9), a
        r["budget"] = math.floor(round(w, 9) * budget_share * total)
    return rows


def _running(df: DataFrame, group: str, order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over earlier rows of the group in ``order``, without one task per group."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = persisted(df.repartitionByRange(n, group, *order).withColumn("pid", F.spark_partition_id()))
    part = ranged.groupBy(group, "pid").agg(F.sum(value).alias("t"))  # at most n rows a group
    before = (part.withColumn("off", F.coalesce(F.sum("t").over(
        Window.partitionBy(group).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(F.col(group).alias("g_"), F.col("pid").alias("p_"), "off"))
    w = Window.partitionBy(group, "pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.withColumn("own", F.coalesce(F.sum(value).over(w), F.lit(0)))
            .join(before, F.col(group).eqNullSafe(F.col("g_")) & (F.col("pid") == F.col("p_")))
            .withColumn(out, F.col("own") + F.col("off")).drop("own", "off", "g_", "p_", "pid"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        target_entropy: float | None = 0.95, max_repetition: float | None = 4.0, budget_share: float = 1.0,
        block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """One row per document and epoch in which it is read: doc_id, source, n_tokens, epoch,
    block (number of the run of the source's permutation), start (tokens of the source read
    before it in its epoch), weight (of the source) and turn (of the block in the schedule).

    The budget is ``budget_share`` of all tokens.
    """
    spark = docs.sparkSession
    rows = persisted(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                                 count_words(F.col(text)).alias("n_tokens"), F.xxhash64(F.col(text)).alias("th")))
    plan_rows = plan(rows, target_entropy, max_repetition, budget_share)
    table = [(r["source"], r["tokens"], r["weight"], r["budget"]) for r in plan_rows]
    sources = spark.createDataFrame(table, "s string, total long, weight double, budget long")
    whole = F.when(F.col("total") > 0, F.floor(F.col("budget") / F.col("total"))).otherwise(0).cast("long")
    per = (rows.join(sources, F.col("source").eqNullSafe(F.col("s")))
           .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), whole)))
           .withColumn("left", F.when(F.col("epoch") < whole, F.col("total"))
                       .otherwise(F.col("budget") - whole * F.col("total")))
           .withColumn("g", F.concat_ws("\x00", F.coalesce("source", F.lit("\x01")), F.col("epoch").cast("string")))
           .withColumn("key", F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("epoch").cast("string"),
                                                F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))))
    out = _running(per.drop("s"), "g", ["key", "th"], "n_tokens", "start")
    read = persisted(out.filter((F.col("total") == 0) | (F.col("epoch") < whole) | (F.col("start") < F.col("left")))
                     .select("doc_id", "source", "n_tokens", "epoch",
                             F.floor(F.col("start") / block_tokens).cast("long").alias("block"), "start", "weight"))
    turns = schedule(read, seed)
    same = [F.col("source").eqNullSafe(F.col("t_source")), F.col("epoch") == F.col("t_epoch"), F.col("block") == F.col("t_block")]
    return read.join(turns, same[0] & same[1] & same[2]).select(*read.columns, "turn")


def schedule(read: DataFrame, seed: int = SEED) -> DataFrame:
    """(t_source, t_epoch, t_block, turn): the blocks of all sources interleaved by their number."""
    blocks = read.select("source", "epoch", "block").distinct()
    numbered = _running(blocks.withColumn("one", F.lit(1).cast("long")).withColumn("g", F.coalesce("source", F.lit("\x01"))),
                        "g", ["epoch", "block"], "one", "j")
    of = numbered.groupBy(F.col("g").alias("h")).agg(F.count(F.lit(1)).alias("m"))
    tie = F.md5(F.concat_ws("-", F.lit(str(seed)), F.coalesce("source", F.lit("")), F.col("epoch").cast("string"), F.col("block").cast("string")))
    placed = (numbered.join(of, F.col("g") == F.col("h"))
              .select("source", "epoch", "block", F.lit("").alias("all"), F.lit(1).cast("long").alias("one"),
                      ((2 * F.col("j") + 1).cast("double") / (2 * F.col("m"))).alias("place"), tie.alias("tie")))
    return _running(placed, "all", ["place", "tie", "source"], "one", "turn").select(
        F.col("source").alias("t_source"), F.col("epoch").alias("t_epoch"), F.col("block").alias("t_block"), "turn")
