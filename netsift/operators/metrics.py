"""Detector evaluation: unsupervised rates, confusion, P/R/F1, ROC-AUC, AP, curves,
per-class report, score densities, feature contrast.

Ranking metrics are tie-grouped: ``groupBy(score)`` gives (pos, neg) per distinct
score; cumulative counts over the descending score order come from a distributed
prefix sum (range partitions + broadcast offsets), so no single task sorts the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .joins import attach_lookup, attach_scalars, materialize
from .quantiles import exact_quantiles

EPS = 1e-9


def unsupervised_result(df: DataFrame, model: str, pred: str = "is_anomaly") -> DataFrame:
    """(model, n_anomalies, anomaly_rate %)."""
    return df.agg(F.lit(model).alias("model"),
                  F.coalesce(F.sum(F.col(pred).cast("bigint")), F.lit(0)).alias("n_anomalies"),
                  F.round(F.avg(F.col(pred).cast("double")) * 100.0, 6).alias("anomaly_rate"))


def confusion(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """tn, fp, fn, tp in one pass (a one-class input gives zeros, not an error)."""
    yy, pp = F.col(y) == 1, F.col(pred) == 1
    return df.agg(F.count_if(~yy & ~pp).alias("tn"), F.count_if(~yy & pp).alias("fp"),
                  F.count_if(yy & ~pp).alias("fn"), F.count_if(yy & pp).alias("tp"))


def prf(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """precision, recall, F1, each with +1e-9 in the denominator."""
    c = confusion(df, y, pred)
    p = F.col("tp") / (F.col("tp") + F.col("fp") + EPS)
    r = F.col("tp") / (F.col("tp") + F.col("fn") + EPS)
    c = c.withColumn("precision", p).withColumn("recall", r)
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + EPS)
    return c.select("tn", "fp", "fn", "tp", F.round("precision", 6).alias("precision"),
                    F.round("recall", 6).alias("recall"), F.round(f1, 6).alias("f1"))


def score_table(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Per distinct score (descending): pos, neg, and the positives / negatives with a
    strictly higher score (``pos_above``, ``neg_above``), plus totals P and N."""
    g = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # checkpointed: the offsets must come from the very ranges they are added to
    g = materialize(g.repartitionByRange(parts, F.desc("s")).withColumn("pid", F.spark_partition_id()))
    tot = g.groupBy("pid").agg(F.sum("pos").alias("pp"), F.sum("neg").alias("pn"))
    prev = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("pid", F.coalesce(F.sum("pp").over(prev), F.lit(0)).alias("op"),
                      F.coalesce(F.sum("pn").over(prev), F.lit(0)).alias("on"),
                      F.sum("pp").over(Window.partitionBy()).alias("P"),
                      F.sum("pn").over(Window.partitionBy()).alias("N"))
    g = g.join(F.broadcast(offs), "pid")  # a row per partition
    w = Window.partitionBy("pid").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    return g.select("s", "pos", "neg",
                    (F.col("op") + F.coalesce(F.sum("pos").over(w), F.lit(0))).alias("pos_above"),
                    (F.col("on") + F.coalesce(F.sum("neg").over(w), F.lit(0))).alias("neg_above"),
                    "P", "N")


def roc_auc(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Exact ROC-AUC with ties counted as one half."""
    t = score_table(df, y, score)
    return t.agg(F.round(F.try_divide(F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2.0)),
                                      F.first("P").cast("double") * F.first("N").cast("double")), 6).alias("roc_auc"))


def average_precision(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Step-wise average precision Σ (R_n − R_{n−1}) · P_n over distinct thresholds."""
    t = score_table(df, y, score)
    tp = F.col("pos_above") + F.col("pos")
    fp = F.col("neg_above") + F.col("neg")
    term = F.when(F.col("pos") > 0, (F.col("pos") / F.col("P")) * (tp / (tp + fp)))
    return t.agg(F.round(F.sum(term), 6).alias("avg_precision"))


def ranking_metrics(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """ROC-AUC and average precision from one score table in one aggregate."""
    t = score_table(df, y, score)
    tp = F.col("pos_above") + F.col("pos")
    fp = F.col("neg_above") + F.col("neg")
    ap = F.when(F.col("pos") > 0, (F.col("pos") / F.col("P")) * (tp / (tp + fp)))
    return t.agg(
        F.round(F.try_divide(F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2.0)),
                             F.first("P").cast("double") * F.first("N").cast("double")), 6).alias("roc_auc"),
        F.round(F.sum(ap), 6).alias("avg_precision"))


def roc_points(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, highest threshold first."""
    t = score_table(df, y, score)
    return t.select(F.col("s").alias("threshold"),
                    F.round(F.try_divide(F.col("neg_above") + F.col("neg"), F.col("N")), 6).alias("fpr"),
                    F.round(F.try_divide(F.col("pos_above") + F.col("pos"), F.col("P")), 6).alias("tpr"))


def pr_points(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) for every distinct score."""
    t = score_table(df, y, score)
    tp = F.col("pos_above") + F.col("pos")
    return t.select(F.col("s").alias("threshold"),
                    F.round(tp / (tp + F.col("neg_above") + F.col("neg")), 6).alias("precision"),
                    F.round(F.try_divide(tp, F.col("P")), 6).alias("recall"))


def class_report(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Per class precision / recall / F1 / support, accuracy, macro and weighted means
    (0/0 → 0)."""
    c = confusion(df, y, pred)
    z = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    tn, fp, fn, tp = F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")
    c = c.select(
        z(tn, tn + fn).alias("p0"), z(tn, tn + fp).alias("r0"), (tn + fp).alias("s0"),
        z(tp, tp + fp).alias("p1"), z(tp, tp + fn).alias("r1"), (tp + fn).alias("s1"),
        z(tp + tn, tn + fp + fn + tp).alias("acc"))
    f = lambda p, r: F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    c = c.withColumn("f0", f(F.col("p0"), F.col("r0"))).withColumn("f1", f(F.col("p1"), F.col("r1")))
    n = F.col("s0") + F.col("s1")
    wavg = lambda a, b: F.coalesce(F.try_divide(F.col(a) * F.col("s0") + F.col(b) * F.col("s1"), n), F.lit(0.0))
    def row(label, p, r, f1, sup):
        return F.struct(F.lit(label).alias("label"), p.alias("precision"), r.alias("recall"),
                        f1.alias("f1"), sup.cast("bigint").alias("support"))

    rows = F.array(
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        row("accuracy", F.col("acc"), F.col("acc"), F.col("acc"), n),
        row("macro avg", (F.col("p0") + F.col("p1")) / 2, (F.col("r0") + F.col("r1")) / 2,
            (F.col("f0") + F.col("f1")) / 2, n),
        row("weighted avg", wavg("p0", "p1"), wavg("r0", "r1"), wavg("f0", "f1"), n),
    )
    r = c.select(F.inline(rows))
    return r.select("label", *[F.round(k, 6).alias(k) for k in ["precision", "recall", "f1"]],
                    F.col("support").cast("bigint").alias("support"))


def score_density(df: DataFrame, score: str = "score", label: str | None = None, bins: int | None = None) -> DataFrame:
    """Score histogram as a density (n / (total · width)); per class when ``label`` is
    given (80 bins, each class with its own range), else 100 bins over all rows."""
    bins = bins or (80 if label else 100)
    grp = F.col(label).cast("string") if label else F.lit("all")
    x = df.select(grp.alias("grp"), F.col(score).cast("double").alias("x")).where(F.col("x").isNotNull())
    rng = x.groupBy("grp").agg(F.min("x").alias("mn"), F.max("x").alias("mx"), F.count(F.lit(1)).alias("tot"))
    rng = rng.select("grp", "tot",
                     F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                     F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    b = attach_lookup(x, rng, "grp", "inner").select(
        "grp", F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int"),
                       F.lit(bins - 1)).alias("bin"))
    cnt = b.groupBy("grp", "bin").agg(F.count(F.lit(1)).alias("n"))
    axis = rng.select("grp", "lo", "hi", "tot", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    w = (F.col("hi") - F.col("lo")) / bins
    return axis.join(cnt, ["grp", "bin"], "left").select(
        F.col("grp").alias("class"), "bin", F.round(F.col("lo") + F.col("bin") * w, 6).alias("bin_lo"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
        F.round(F.coalesce(F.col("n"), F.lit(0)) / (F.col("tot") * w), 6).alias("density"))


def score_density_with_threshold(df: DataFrame, score: str = "score", pct: float = 95.0, bins: int = 100) -> DataFrame:
    """Density of all scores (``bins`` bins) with the ``pct``-th percentile as ``threshold`` on
    every row and ``flagged`` for bins that begin above it."""
    d = attach_scalars(score_density(df, score, bins=bins), percentile_threshold(df, score, pct))
    return d.withColumn("threshold", F.round("threshold", 6)).withColumn(
        "flagged", (F.col("bin_lo") > F.col("threshold")).cast("int"))


def feature_contrast(df: DataFrame, cols: list[str], mask: str = "is_anomaly", top: int = 15) -> DataFrame:
    """Mean of each (scaled) feature among anomalies and among normal rows, absolute
    difference, the ``top`` largest differences. One conditional-average pass."""
    a = F.col(mask) == 1
    r = df.agg(*[F.avg(F.when(a, F.col(c))).alias(f"a{i}") for i, c in enumerate(cols)],
               *[F.avg(F.when(~a, F.col(c))).alias(f"n{i}") for i, c in enumerate(cols)])
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("mean_normal"),
                               F.col(f"a{i}").alias("mean_anomaly")) for i, c in enumerate(cols)])
    long = r.select(F.inline(items)).withColumn("abs_diff", F.abs(F.col("mean_anomaly") - F.col("mean_normal")))
    return long.orderBy(F.desc("abs_diff"), "feature").limit(top).select(
        "feature", *[F.round(k, 6).alias(k) for k in ["mean_normal", "mean_anomaly", "abs_diff"]])


def percentile_threshold(df: DataFrame, score: str, pct: float) -> DataFrame:
    """One row ``threshold``: the linear ``pct``-th percentile of the scores (exact,
    distributed)."""
    return exact_quantiles(df, score, [pct / 100.0]).select(F.col("q0").alias("threshold"))


def flag_above(df: DataFrame, score: str, pct: float, out: str = "is_anomaly", strict: bool = True) -> DataFrame:
    """Attach ``threshold`` and the flag score > threshold (≥ when not strict)."""
    t = percentile_threshold(df, score, pct)
    d = attach_scalars(df, t)
    cond = F.col(score) > F.col("threshold") if strict else F.col(score) >= F.col("threshold")
    return d.withColumn(out, F.coalesce(cond.cast("int"), F.lit(0)))


def supervised_comparison(results: list[DataFrame]) -> DataFrame:
    """Union of per-model metric rows unpivoted to (model, metric, value)."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)
    metrics = [m for m in ["precision", "recall", "f1", "roc_auc", "avg_precision"] if m in u.columns]
    return u.unpivot("model", metrics, "metric", "value").select(
        "model", "metric", F.round(F.col("value").cast("double"), 6).alias("value"))
