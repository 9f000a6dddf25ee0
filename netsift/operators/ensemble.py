"""Ensemble over detectors: one pass for all matrix models, votes and average ranks by row id.

* ``score_all`` evaluates any number of fitted matrix models (isolation forest, one-class SVM,
  autoencoder) on each Arrow batch: the features go to Python once, not once per model.
* ``percent_ranks`` turns scores, whose scales differ between detectors, into the share of rows
  with a smaller score. Ranks come from range partitions of value counts, as the exact
  quantiles do; no task holds all scores.
* ``vote`` joins the detectors' (id, score, flag) tables: votes, majority flag, mean rank.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .detectors.base import DetectorModel, as_array
from .joins import attach_lookup, materialize


def score_all(df: DataFrame, models: dict[str, DetectorModel], features_col: str = "features") -> DataFrame:
    """``df`` with ``score_<name>`` and ``flag_<name>`` of every model, from one Arrow pass. A row
    without features has null scores and flags 0."""
    names = sorted(models)
    fns = [models[n].matrix_scorer() for n in names]

    @F.pandas_udf(", ".join(f"s{i} double" for i in range(len(names))))
    def scores(x: pd.Series) -> pd.DataFrame:
        known = x.notna().to_numpy()
        m = np.array(x[known].tolist(), dtype=float)
        out = np.full((len(x), len(names)), np.nan)
        for i, fn in enumerate(fns):
            if fn is not None and known.any():
                out[known, i] = fn(m)
        pdf = pd.DataFrame(out, columns=[f"s{i}" for i in range(len(names))])
        return pdf.astype(object).where(pdf.notna(), None)

    # not deterministic for the optimiser: a filter on a score must not run the models a second time
    got = df.withColumn("__s", scores.asNondeterministic()(as_array(df, features_col)))
    cols = []
    for i, n in enumerate(names):
        s = F.col(f"__s.s{i}")
        cols += [s.alias(f"score_{n}"), F.coalesce((s > F.lit(models[n].threshold)).cast("int"), F.lit(0)).alias(f"flag_{n}")]
    return got.select(*df.columns, *cols)


def percent_ranks(scored: DataFrame, score: str, out: str) -> DataFrame:
    """``scored`` with ``out``: rows with a smaller score over all other rows (0 for a single row; null scores: null)."""
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = scored.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("v_")).agg(F.count(F.lit(1)).alias("c_"))
    ranged = materialize(counts.repartitionByRange(parts, "v_").withColumn("pid", F.spark_partition_id()))
    per = ranged.groupBy("pid").agg(F.sum("c_").alias("t"))  # a row per partition
    offs = per.select("pid", F.coalesce(F.sum("t").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)),
                                        F.lit(0)).alias("off"), F.sum("t").over(Window.partitionBy()).alias("n_"))
    below = F.sum("c_").over(Window.partitionBy("pid").orderBy("v_").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c_")
    ranks = (ranged.withColumn("own", below).join(F.broadcast(offs), "pid")
             .select("v_", F.coalesce(F.try_divide(F.col("own") + F.col("off"), F.col("n_") - 1), F.lit(0.0)).alias(out)))
    return attach_lookup(scored, ranks, scored[score] == F.col("v_")).drop("v_")


def vote(detectors: dict[str, DataFrame], id_col: str = "id", score: str = "anomaly_score", flag: str = "is_anomaly",
         least: int | None = None) -> DataFrame:
    """(id, flag_<name>..., n_votes, is_anomaly, mean_rank) from each detector's (id, score, flag) table.

    ``least`` votes make an anomaly (a majority if None). ``mean_rank`` averages the percent ranks of the
    scores; a row that a detector did not score has no vote and no rank of it.
    """
    names = sorted(detectors)
    out = None
    for n in names:
        one = percent_ranks(detectors[n].select(F.col(id_col).alias("id"), F.col(score).alias("s_"),
                                                F.col(flag).cast("int").alias(f"flag_{n}")), "s_", f"rank_{n}").drop("s_")
        out = one if out is None else out.join(one, "id", "full")
    flags = [F.coalesce(f"flag_{n}", F.lit(0)) for n in names]
    ranks = F.array_compact(F.array(*(F.col(f"rank_{n}") for n in names)))
    mean = F.try_divide(F.aggregate(ranks, F.lit(0.0), lambda a, r: a + r), F.size(ranks))
    total = sum(flags[1:], flags[0])
    return out.select(F.col("id").alias(id_col), *(f.alias(f"flag_{n}") for n, f in zip(names, flags)), total.alias("n_votes"),
                      (total >= (least or len(names) // 2 + 1)).cast("int").alias("is_anomaly"), mean.alias("mean_rank"))
