"""Review export and anomaly summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import EXPORT_COLUMNS, NIGHT_HOURS, REVIEW_COLUMNS, TOP_EXPORT, TOP_SUMMARY
from .joins import attach_scalars
from .profile import top_values


def top_anomalies(scored: DataFrame, top_n: int = TOP_EXPORT, key: str | None = "session_id",
                  mask: str = "is_anomaly", score: str = "anomaly_score") -> DataFrame:
    """Anomalous rows, score descending (key as tie-break), first ``top_n``, the export
    columns that exist, plus empty ``manual_label`` and ``notes``.

    Planned as ``TakeOrderedAndProject``: each partition keeps its own top-n, the
    driver merges n·partitions rows at most.
    """
    order = [F.desc(score)] + ([F.asc(key)] if key and key in scored.columns else [])
    top = scored.where(F.col(mask) == 1).orderBy(*order).limit(top_n)
    cols = [c for c in EXPORT_COLUMNS if c in scored.columns]
    return top.select(*cols, *[F.lit("").alias(c) for c in REVIEW_COLUMNS])


def export_file_name(model: str, top_n: int = TOP_EXPORT) -> str:
    return f"anomalies_{model.lower().replace(' ', '_')}_top{top_n}.csv"


def export_top_anomalies(scored: DataFrame, model: str, output_dir: str, top_n: int = TOP_EXPORT, **kw) -> str:
    """Write the review list as one CSV folder (the list is at most ``top_n`` rows)."""
    from ..sources.files import write_csv
    path = output_dir.rstrip("/") + "/" + export_file_name(model, top_n)
    write_csv(top_anomalies(scored, top_n, **kw), path, single_file=True)
    return path


def anomaly_summary(scored: DataFrame, mask: str = "is_anomaly", score: str = "anomaly_score") -> DataFrame:
    """Headline numbers: anomalies and their percent, mean anomaly score, max score,
    night/day split of anomalies (NULL hour counts as day). Percentages of zero
    anomalies are NULL instead of a division error."""
    a = F.col(mask) == 1
    night = a & F.col("hour").isin(NIGHT_HOURS) if "hour" in scored.columns else F.lit(False)
    r = scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(a).alias("n_anomalies"),
                   F.avg(F.when(a, F.col(score))).alias("mean_anomaly_score"),
                   F.max(score).alias("max_score"), F.count_if(night).alias("n_night"))
    return r.select(
        "n_rows", "n_anomalies",
        F.round(F.try_divide(F.col("n_anomalies") * 100.0, F.col("n_rows")), 6).alias("pct_anomalies"),
        F.round("mean_anomaly_score", 6).alias("mean_anomaly_score"), F.round("max_score", 6).alias("max_score"),
        "n_night", (F.col("n_anomalies") - F.col("n_night")).alias("n_day"),
        F.round(F.try_divide(F.col("n_night") * 100.0, F.col("n_anomalies")), 6).alias("pct_night"),
        F.round(F.try_divide((F.col("n_anomalies") - F.col("n_night")) * 100.0, F.col("n_anomalies")), 6)
        .alias("pct_day"))


def anomaly_top_values(scored: DataFrame, mask: str = "is_anomaly", k: int = TOP_SUMMARY) -> DataFrame:
    """Top-k src_ip, dst_port, application among anomalies, with percent of anomalies."""
    t = top_values(scored, ("src_ip", "dst_port", "application"), k, where=F.col(mask) == 1)
    total = scored.agg(F.count_if(F.col(mask) == 1).alias("_na"))
    return attach_scalars(t, total).select(
        "dimension", "rank", "value", "n", F.round(F.try_divide(F.col("n") * 100.0, F.col("_na")), 6)
        .alias("pct_of_anomalies"))


def compare_unsupervised(results: list[DataFrame], target_rate: float = 5.0) -> DataFrame:
    """Union of (model, n_anomalies, anomaly_rate) rows ranked by |rate − target|."""
    u = reduce(DataFrame.unionByName, results)
    return u.withColumn("rate_deviation", F.round(F.abs(F.col("anomaly_rate") - target_rate), 6)) \
        .orderBy("rate_deviation", "model")
