"""Filter interaction audit: what each filter of a chain removes, in every order.

Five filters fail a document: A under 200 words; B fewer than half of its words distinct;
C over 3% capitals A-Z; D holds one of ``#$%&*|``; E its text is that of a smaller id.

*E* is an existential self-join: rows are left-semi joined on hash, exact text and a smaller
id. The right side is first reduced to one row per text that several rows hold (its least
id; partial aggregation, so a group of copies of any size is one row), checkpointed, and
joined from an exchange of its own, so that Spark can split the rows of a hot text.

*Combinations.* The ids that E marks are united with the failures of the other filters, a
bit each, aggregated to one row per document, joined with its labels and counted per part
and combination of bits: at most 32 rows a part, whatever the table's size. Every order of
the filters is then read from these counts: a document goes at the first filter of the
order that it fails.

Edge cases: a null text is an empty text; a null part is the part ''; a null id is never
smaller nor larger than another, so E does not mark it, and it has no label; rows equal in
id and text are marked alike and each counted; several labels of an id count by their
largest; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_filter, persisted

FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 200
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def text_failures(text: Column) -> Column:
    """Bits 1, 2, 4, 8: the text fails A, B, C, D."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    fails = [n < MIN_WORDS,
             100 * F.size(F.array_distinct(words)).cast("long") < 50 * n.cast("long"),
             100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 3 * F.length(text).cast("long"),
             text.rlike(r"[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def repeated_texts(rows: DataFrame) -> DataFrame:
    """Rows (id, hash, text, ...) whose text a smaller id holds."""
    first = persisted(rows.groupBy(F.col("hash").alias("h"), F.col("text").alias("t"))
                      .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
    near = bucket_filter(rows, "hash", first, "h")  # only texts that may repeat are moved
    return near.join(first, (F.col("hash") == F.col("h")) & (F.col("text") == F.col("t"))
                     & (F.col("least") < F.col("id")), "left_semi")


def combinations(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 part: str = "lang") -> DataFrame:
    """(part, bits, n, good, toxic): documents per combination of failed filters (E: 16)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       body.alias("text"), F.xxhash64(body).alias("hash"))
    key = ["id", "hash", "part"]
    of_text = rows.select(*key, text_failures(F.col("text")).alias("bits"), F.lit(1).alias("n"))
    of_copy = repeated_texts(rows).select(*key, F.lit(16).alias("bits"), F.lit(0).alias("n"))
    failed = of_text.unionByName(of_copy).groupBy(*key).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    known = labels.groupBy(F.col("doc_id").alias("l_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    return (failed.join(known, F.col("id") == F.col("l_id"), "left").groupBy("part", "bits")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
                 F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")))


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          part: str = "lang") -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley."""
    counts = persisted(combinations(docs, labels, doc_id, text, part))  # 32 rows a part at most

    # an order as its text and the bit of the filter at each step
    orders = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.array(*(F.lit(1 << FILTERS.index(x)) for x in o)).alias("masks"))
                       for o in ORDERS))

    def hits(mask: Column) -> Column:
        return F.col("bits").bitwiseAND(mask) != 0

    # the step at which a combination goes: the first filter of the order that it fails; 6 if none
    goes = F.lit(6)
    for i in range(5, 0, -1):
        goes = F.when(hits(F.col("o.masks")[i - 1]), i).otherwise(goes)
    at = (counts.select("*", F.explode(orders).alias("o")).select("*", goes.alias("goes"), F.posexplode("o.masks").alias("i", "mask"))
          .select("*", "o.filter_order", (F.col("i") + 1).alias("step"), hits(F.col("mask")).alias("hit")))

    def total(when: Column, what: str = "n") -> Column:
        return F.sum(F.when(when, F.col(what)).otherwise(0)).cast("long")

    here = F.col("goes") == F.col("step")
    table = at.groupBy("part", "filter_order", "step", "mask").agg(
        total(F.col("goes") > F.col("step")).alias("kept"), total(here).alias("removed"),
        total(F.col("hit") & (F.col("goes") < F.col("step"))).alias("redundant"),
        total(F.col("hit") & (F.bit_count("bits") == 1)).alias("unique_fails"),
        total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"))
    shares = table.groupBy(F.col("part").alias("p"), F.col("mask").alias("m")).agg(F.sum("removed").alias("shapley"))
    return (table.join(shares, (F.col("part") == F.col("p")) & (F.col("mask") == F.col("m")))
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                    "toxic_lost", "shapley"))
