"""Traffic profile: the aggregates behind every exploratory chart.

Each function returns a small DataFrame (its size is bounded by a time span, a
number of bins, columns or k — never by the number of rows). Inputs are scanned
with column pruning; global scalars (min/max, totals) are one-row aggregates
attached by broadcast, never collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ID_COLUMNS, TOP_PROFILE, TRAFFIC_COLUMNS, WEEKDAY_NAMES
from .joins import attach_scalars
from .quantiles import grouped_quantiles

GB = float(1024 ** 3)


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


def basic_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    """Rows; first/last time and whole-day span; distinct sources, destinations and
    applications; total traffic (GB) and mean KB per session. One pass."""
    dc = F.approx_count_distinct if approx else F.count_distinct
    aggs = [F.count(F.lit(1)).alias("n_sessions")]
    if "timestamp" in df.columns:
        aggs += [F.min("timestamp").alias("ts_min"), F.max("timestamp").alias("ts_max")]
    for c in _present(df, ["src_ip", "dst_ip", "application"]):
        aggs.append(dc(c).alias(f"n_{c}"))
    has_bytes = "bytes_sent" in df.columns and "bytes_rcvd" in df.columns
    if has_bytes:
        aggs += [F.sum("bytes_sent").alias("_bs"), F.sum("bytes_rcvd").alias("_br")]
    r = df.agg(*aggs)
    out = [c for c in r.columns if not c.startswith("_")]
    if "timestamp" in df.columns:
        span = F.floor(F.timestamp_diff("SECOND", F.col("ts_min"), F.col("ts_max")) / 86400).cast("bigint")
        r = r.withColumn("span_days", span)
        out.append("span_days")
    if has_bytes:
        tot = (F.coalesce(F.col("_bs"), F.lit(0)) + F.coalesce(F.col("_br"), F.lit(0))).cast("double")
        r = r.withColumn("total_gb", F.round(tot / GB, 6)) \
             .withColumn("mean_kb", F.round(F.try_divide(tot, F.col("n_sessions")) / 1024.0, 6))
        out += ["total_gb", "mean_kb"]
    return r.select(*out)


def frame_census(df: DataFrame) -> DataFrame:
    """Per column: Spark type, non-null count, row count (the ``info()`` table). One pass."""
    cols = df.columns
    r = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    types = {c: df.schema[c].dataType.simpleString() for c in cols}
    items = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                               F.col(f"c{i}").alias("non_null")) for i, c in enumerate(cols)])
    return r.select(F.col("__n").alias("n_rows"), F.inline(items)).select(
        "position", "column", "dtype", "non_null", "n_rows")


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """Counts per value (NULL excluded) and percent of **all** rows; optional top-k with
    a value tie-break."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    vc = attach_scalars(vc, total).withColumn("pct", F.round(F.col("n") * 100.0 / F.col("_total"), 6)).drop("_total")
    if top:
        vc = vc.orderBy(F.desc("n"), F.asc(col)).limit(top)
    return vc


AXIS_RUN = 1024


def _dense_axis(lo_hi: DataFrame, unit: str, name: str) -> DataFrame:
    """One row per time bin between the first and last bin (bounded by the time span), made as
    runs of bins, so that no row ever holds the whole axis."""
    n = lo_hi.select("_lo", F.timestamp_diff(unit.upper(), F.col("_lo"), F.col("_hi")).alias("_n")).where("_n >= 0")
    runs = n.select("_lo", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n"), F.lit(AXIS_RUN).cast("long"))).alias("_k"))
    last = F.least(F.col("_n"), F.col("_k") + (AXIS_RUN - 1))
    at = runs.select("_lo", F.explode(F.sequence(F.col("_k"), last)).alias("_i"))
    return at.select(F.timestamp_add(unit.upper(), F.col("_i").cast("int"), F.col("_lo")).alias(name))


def traffic_timeline(df: DataFrame, unit: str = "hour", ts: str = "timestamp",
                     flag: str | None = None) -> DataFrame:
    """Sessions (and bytes) per time bin with empty bins emitted as 0 (resample).

    With ``flag`` the anomalous count per bin is added (``count_if(flag = 1)``).
    """
    b = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")
    rows = df.where(F.col(ts).isNotNull()).withColumn("bin", b)
    aggs = [F.count(F.lit(1)).alias("sessions")]
    if "bytes_sent" in df.columns:
        aggs += [F.sum("bytes_sent").cast("bigint").alias("bytes_sent"),
                 F.sum("bytes_rcvd").cast("bigint").alias("bytes_rcvd")]
    if flag:
        aggs.append(F.count_if(F.col(flag) == 1).alias("anomalies"))
    per_bin = rows.groupBy("bin").agg(*aggs)
    axis = _dense_axis(per_bin.agg(F.min("bin").alias("_lo"), F.max("bin").alias("_hi")), unit, "bin")
    out = axis.join(per_bin, "bin", "left")
    fills = {c: 0 for c in out.columns if c != "bin"}
    out = out.na.fill(fills)
    if "bytes_sent" in df.columns:
        out = out.withColumn("gb_sent", F.round(F.col("bytes_sent") / GB, 9)) \
                 .withColumn("gb_rcvd", F.round(F.col("bytes_rcvd") / GB, 9))
    return out


def activity_pivot(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Sessions per weekday × hour: one row per observed weekday (Monday first),
    24 hour columns ``h00``…``h23`` zero-filled (fixed width keeps the schema stable)."""
    rows = df.where(F.col(ts).isNotNull()).select(F.weekday(ts).alias("day_of_week"), F.hour(ts).alias("hour"))
    p = rows.groupBy("day_of_week").pivot("hour", list(range(24))).count().na.fill(0)
    names = F.create_map(*[x for i, n in enumerate(WEEKDAY_NAMES) for x in (F.lit(i), F.lit(n))])
    cols = [F.coalesce(F.col(str(h)), F.lit(0)).cast("bigint").alias(f"h{h:02d}") for h in range(24)]
    return p.select(F.element_at(names, F.col("day_of_week")).alias("day_name"), "day_of_week", *cols) \
        .orderBy("day_of_week")


def histograms(df: DataFrame, cols=None, bins: int = 50, log1p: bool = False) -> DataFrame:
    """Equal-width histograms (last bin right-closed; a constant column spans ±0.5).

    Long output: (feature, bin, lo, hi, n) with every bin present (zeros included).
    With ``log1p`` the values are ``log1p(x)`` first.
    """
    cols = _present(df, cols or TRAFFIC_COLUMNS)
    val = (lambda c: F.log1p(F.col(c).cast("double"))) if log1p else (lambda c: F.col(c).cast("double"))
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), val(c).alias("x")) for c in cols]))
                     .alias("e")).select("e.*").where(F.col("x").isNotNull() & ~F.isnan("x"))
    rng = long.groupBy("feature").agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    rng = rng.select("feature",
                     F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                     F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    # per-feature ranges: one row per profiled column, broadcast
    binned = long.join(F.broadcast(rng), "feature").select(
        "feature", F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int"),
                           F.lit(bins - 1)).alias("bin"))
    counts = binned.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    axis = rng.select("feature", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    w = (F.col("hi") - F.col("lo")) / bins
    return axis.join(counts, ["feature", "bin"], "left").select(
        "feature", "bin",
        F.round(F.col("lo") + F.col("bin") * w, 6).alias("bin_lo"),
        F.round(F.col("lo") + (F.col("bin") + 1) * w, 6).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def numeric_columns(df: DataFrame, exclude=ID_COLUMNS) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


SHIFT_ROWS = 1000


def corr_matrix(df: DataFrame, cols=None) -> DataFrame:
    """Pearson correlation with pairwise deletion, strict lower triangle (i > j) as
    (col_a, col_b, corr); zero variance → NULL.

    One pass of Arrow batches: each partition turns its block into moment matrices with
    BLAS products over the non-null masks (pair counts, sums, cross-products of values
    shifted by the column means of the first rows, which avoids cancellation and changes no
    result); a distributed sum merges them. Output and state are bounded by columns², not
    rows. Without a row every correlation is NULL.
    """
    import numpy as np
    import pandas as pd

    cols = cols or numeric_columns(df)
    c = len(cols)
    x = df.select(*[F.col(k).cast("double").alias(f"c{i}") for i, k in enumerate(cols)])
    names = [f"c{i}" for i in range(c)]
    head = x.limit(SHIFT_ROWS).toPandas()[names].astype(float)
    shift = np.nan_to_num(head.replace([np.inf, -np.inf], np.nan).mean().to_numpy())

    def moments(batches):
        acc = None
        for pdf in batches:
            X = pdf[names].to_numpy(dtype=float) - shift
            M = (~np.isnan(X)).astype(float)
            X0 = np.where(M > 0, X, 0.0)
            part = np.concatenate([(M.T @ M).ravel(), (X0.T @ M).ravel(), (X0.T @ X0).ravel(),
                                   ((X0 * X0).T @ M).ravel()])
            acc = part if acc is None else acc + part
        if acc is not None:
            yield pd.DataFrame({"m": [acc.tolist()]})

    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    spark = df.sparkSession
    zero = spark.range(1).select(F.array_repeat(F.lit(0.0), 4 * c * c).alias("m"))  # a sum needs one row
    parts = x.mapInPandas(moments, "m array<double>").unionByName(zero)
    tot = parts.select(array_to_vector("m").alias("m")).agg(Summarizer.sum(F.col("m")).alias("m")).first()
    m = tot["m"].toArray().reshape(4, c, c)
    n, sa, sab, saa = m[0], m[1], m[2], m[3]   # sa[i, j] = Σ x_i over rows where x_i, x_j present
    rows = []
    for i in range(c):
        for j in range(i):
            nn = n[i, j]
            if nn <= 0:
                rows.append((cols[i], cols[j], None))
                continue
            ma, mb = sa[i, j] / nn, sa[j, i] / nn
            cov = sab[i, j] / nn - ma * mb
            va = saa[i, j] / nn - ma * ma
            vb = saa[j, i] / nn - mb * mb
            den = np.sqrt(va * vb) if va > 0 and vb > 0 else 0.0
            val = None if den <= 0 or abs(va) < 1e-300 else float(round(cov / den, 6))
            if val is not None and (va <= 1e-12 * max(1.0, abs(ma) ** 2) or vb <= 1e-12 * max(1.0, abs(mb) ** 2)):
                val = None
            rows.append((cols[i], cols[j], val))
    return spark.createDataFrame(rows, "col_a string, col_b string, corr double")


def top_values(df: DataFrame, cols=("src_ip", "dst_ip", "dst_port", "application"), k: int = TOP_PROFILE,
               where=None) -> DataFrame:
    """Top-k values by sessions for several columns: (dimension, rank, value, n).

    Each column is aggregated on its own (the scan reads that one column), and its
    top-k is a ``TakeOrderedAndProject`` (per-partition top-k, then a k-row merge), so
    no column's distinct values are gathered into a single task.
    """
    from pyspark.sql.window import Window
    cols = _present(df, cols)
    src = df if where is None else df.where(where)
    parts = []
    for c in cols:
        counts = src.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("value")) \
            .agg(F.count(F.lit(1)).alias("n"))
        parts.append(counts.orderBy(F.desc("n"), F.asc("value")).limit(k)
                     .select(F.lit(c).alias("dimension"), "value", "n"))
    allk = reduce(DataFrame.unionByName, parts)
    # k·dims rows: a bounded window
    return allk.withColumn("rank", F.row_number().over(Window.partitionBy("dimension")
                                                        .orderBy(F.desc("n"), F.asc("value"))).cast("int")) \
        .select("dimension", "rank", "value", "n")


def iqr_outliers(df: DataFrame, cols=None) -> DataFrame:
    """Quartiles (linear), IQR, 1.5·IQR fences, whiskers, outlier count and percent of
    all rows, per column. Two passes for all columns together: one grouped exact
    quantile over the long (feature, value) form, one outlier count against the
    broadcast fences."""
    cols = _present(df, cols or TRAFFIC_COLUMNS)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                                         for c in cols])).alias("e")).select("e.*")
    q = grouped_quantiles(long, "feature", "x", [0.25, 0.5, 0.75])
    q = q.select("feature", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lower_fence", F.col("q1") - 1.5 * F.col("iqr")) \
         .withColumn("upper_fence", F.col("q3") + 1.5 * F.col("iqr"))
    x = F.col("x")
    # fences: one row per profiled column, broadcast
    stats = long.join(F.broadcast(q.select("feature", "lower_fence", "upper_fence")), "feature").groupBy(
        "feature").agg(
        F.count_if((x < F.col("lower_fence")) | (x > F.col("upper_fence"))).alias("n_outliers"),
        F.min(F.when(x >= F.col("lower_fence"), x)).alias("whisker_low"),
        F.max(F.when(x <= F.col("upper_fence"), x)).alias("whisker_high"))
    total = df.agg(F.count(F.lit(1)).alias("n_rows"))
    out = attach_scalars(q.join(stats, "feature", "left"), total)
    return out.select(
        "feature", *[F.round(F.col(k), 6).alias(k) for k in
                     ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "whisker_low", "whisker_high"]],
        F.coalesce(F.col("n_outliers"), F.lit(0)).alias("n_outliers"),
        F.round(F.try_divide(F.coalesce(F.col("n_outliers"), F.lit(0)) * 100.0, F.col("n_rows")), 6)
        .alias("pct_outliers"))


def class_distribution(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """Rows and share per class value (keyed by value, not by position)."""
    total = df.agg(F.count(F.lit(1)).alias("_t"))
    c = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return attach_scalars(c, total).select("class", "n", F.round(F.col("n") / F.col("_t"), 6).alias("share"))


def label_census(df: DataFrame, pred: str = "is_anomaly", score: str = "anomaly_score") -> DataFrame:
    """Per predicted label: rows, min and max score."""
    return df.groupBy(F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.min(score), 6).alias("min_score"),
        F.round(F.max(score), 6).alias("max_score"))
