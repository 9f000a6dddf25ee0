"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, decontamination, mixing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame. ``run`` writes each stage's result as Parquet in the shared checkpoint folder
and reads it again as the next one's documents. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm import decontam, linededup, mixing, simhash, toxicity
from netsift.llm.common import fold_of, packed, persisted, table
from netsift.llm.queries import contaminated
from netsift.session import checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject (score below 0.5)."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold_of("doc_id", 5) != 0)
    scored = toxicity.score(docs, model, keep=docs.columns)
    return scored.filter(F.col(scored.columns[-1]) < 0.5).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat an earlier line; documents left empty, or with less than a
    fifth of the characters of their distinct lines (what is left of a near copy is a fragment), go."""
    return linededup.dedup_documents(docs)


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, text, key): the columns of ``docs`` as one struct, so that they may have any name, the
    text, and the id (null ids last) with the text's hash, which tell rows apart."""
    return docs.select(packed(docs).alias("row"), F.col("text"),
                       F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                                F.xxhash64("text").alias("th")).alias("key"))


def _matches(keys: DataFrame, key: str) -> tuple[DataFrame, Column]:
    """``keys`` as columns k_id, k_th, and the condition that joins them to ``_keyed`` rows."""
    k = keys.select(F.col(key + ".id").alias("k_id"), F.col(key + ".th").alias("k_th"))
    return k, F.col("key.id").eqNullSafe(F.col("k_id")) & (F.col("key.th") == F.col("k_th"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id (then text hash;
    rows without an id come last), and one row of it."""
    rows = _keyed(docs)
    comp = simhash.near_duplicates(rows, doc_id="key")
    heads = persisted(comp.filter(F.col("doc_id") == F.col("component_id"))
                      .groupBy("component_id").agg(F.count(F.lit(1)).alias("n")))
    keys, on = _matches(heads, "component_id")
    kept = rows.join(keys, on, "left_semi")
    if not heads.filter(F.col("n") > 1).isEmpty():  # repeated rows: only then is this shuffle needed
        kept = kept.dropDuplicates(["key"])
    return kept.select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark passages."""
    rows = _keyed(docs)
    found = decontam.find_phrases(rows, table(spark, sf_dir, "benchmark"), doc_id="key", slop=0)  # the contract's exact rule
    bad = persisted(found.filter(contaminated()).select("doc_id").distinct())
    keys, on = _matches(bad, "doc_id")
    return rows.join(keys, on, "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The reading schedule: a row per document and epoch."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Trained models and fingerprint components are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
