"""Threat rules named by the detector's documentation, as batch Spark jobs.

Thresholds are parameters. Windowed rules are ``groupBy(window(ts), keys)`` with
partial aggregation. Sliding windows are made of panes (tumbling windows that divide both the
window and its slide): rows are aggregated once per pane, and only pane aggregates are
copied into the windows they lie in. Distinct counts are exact by default (a row per pane,
source and target); ``approx=True`` keeps one mergeable sketch per pane and source instead,
as the streaming versions do.
"""

from __future__ import annotations

from functools import reduce
from math import gcd

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

from .joins import attach_scalars, materialize
from .quantiles import exact_quantiles


def ddos(df: DataFrame, window: str = "5 minutes", min_connections: int = 100, min_packets: int = 100000,
         ts: str = "timestamp") -> DataFrame:
    """Connections and packets per source per tumbling window; alert when either is high."""
    pk = F.coalesce(F.col("pkts_sent"), F.lit(0)) + F.coalesce(F.col("pkts_rcvd"), F.lit(0))
    g = df.where(F.col(ts).isNotNull()).groupBy(F.window(ts, window).alias("w"), "src_ip").agg(
        F.count(F.lit(1)).alias("connections"), F.sum(pk).cast("bigint").alias("packets"))
    return g.where((F.col("connections") >= min_connections) | (F.col("packets") >= min_packets)).select(
        F.col("w.start").alias("window_start"), "src_ip", "connections", "packets")


def pane_length(window: str, slide: str) -> str:
    """The longest tumbling window that divides ``window`` and ``slide``."""
    return f"{gcd(*(int(pd.Timedelta(x).total_seconds()) for x in (window, slide)))} seconds"


def _scan(df, target, window, slide, min_distinct, ts, approx, name):
    pane = F.window(ts, pane_length(window, slide)).alias("p")
    rows = df.where(F.col(ts).isNotNull())
    if approx:  # a sketch takes numbers or texts; null targets are not counted
        kind = "bigint" if isinstance(df.schema[target].dataType, IntegralType) else "string"
        panes = rows.groupBy(pane, "src_ip").agg(F.hll_sketch_agg(F.col(target).cast(kind)).alias("held"),
                                                 F.count(F.lit(1)).alias("n"))
        distinct = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("held")), F.lit(0))
    else:
        panes = rows.groupBy(pane, "src_ip", F.col(target).alias("held")).agg(F.count(F.lit(1)).alias("n"))
        distinct = F.count_distinct("held")
    g = (panes.withColumn("t", F.col("p.start")).groupBy(F.window("t", window, slide).alias("w"), "src_ip")
         .agg(distinct.alias(name), F.sum("n").alias("connections")))
    return g.where(F.col(name) >= min_distinct).select(F.col("w.start").alias("window_start"), "src_ip", name,
                                                        "connections")


def port_scan(df: DataFrame, window: str = "10 minutes", slide: str = "5 minutes", min_ports: int = 20,
              ts: str = "timestamp", approx: bool = False) -> DataFrame:
    """Distinct destination ports per source in sliding windows."""
    return _scan(df, "dst_port", window, slide, min_ports, ts, approx, "distinct_ports")


def network_scan(df: DataFrame, window: str = "10 minutes", slide: str = "5 minutes", min_hosts: int = 20,
                 ts: str = "timestamp", approx: bool = False) -> DataFrame:
    """Distinct destination addresses per source in sliding windows."""
    return _scan(df, "dst_ip", window, slide, min_hosts, ts, approx, "distinct_hosts")


def exfiltration(df: DataFrame, pct: float = 99.0, min_ratio: float = 10.0) -> DataFrame:
    """Per source: bytes out / in; alert above the ``pct`` percentile of bytes out over
    sources and with out/in ratio above ``min_ratio``."""
    s = df.groupBy("src_ip").agg(F.sum("bytes_sent").cast("bigint").alias("bytes_out"),
                                 F.sum("bytes_rcvd").cast("bigint").alias("bytes_in"),
                                 F.count(F.lit(1)).alias("sessions"))
    s = s.withColumn("out_in_ratio", F.round(F.col("bytes_out") / (F.col("bytes_in") + 1.0), 6))
    t = exact_quantiles(s, "bytes_out", [pct / 100.0]).select(F.col("q0").alias("threshold"))
    s = attach_scalars(s, t)
    return s.where((F.col("bytes_out") > F.col("threshold")) & (F.col("out_in_ratio") > min_ratio)).select(
        "src_ip", "bytes_out", "bytes_in", "sessions", "out_in_ratio", F.round("threshold", 6).alias("threshold"))


def ratio_scores(df: DataFrame, pct: float = 95.0) -> DataFrame:
    """Per-session exfiltration indicator: ``anomaly_score`` = bytes_sent/(bytes_rcvd+1);
    ``is_anomaly`` when above the ``pct`` percentile of all sessions' scores."""
    s = df.withColumn("anomaly_score", F.col("bytes_sent") / (F.col("bytes_rcvd") + 1.0))
    t = exact_quantiles(s, "anomaly_score", [pct / 100.0]).select(F.col("q0").alias("_thr"))
    s = attach_scalars(s, t)
    return s.withColumn("is_anomaly", F.coalesce((F.col("anomaly_score") > F.col("_thr")).cast("int"),
                                                 F.lit(0))).drop("_thr")


def brute_force(events: DataFrame, window: str = "5 minutes", min_denies: int = 5,
                ts: str = "ts") -> DataFrame:
    """Denied attempts per (window, source, destination port); reads pre-pairing events."""
    d = events.where(F.lower(F.col("action")) == "deny")
    g = d.where(F.col(ts).isNotNull()).groupBy(F.window(ts, window).alias("w"), "src_ip", "dst_port") \
        .agg(F.count(F.lit(1)).alias("denies"))
    return g.where(F.col("denies") >= min_denies).select(F.col("w.start").alias("window_start"), "src_ip",
                                                         "dst_port", "denies")


def beaconing(df: DataFrame, min_connections: int = 10, max_cv: float = 0.2, max_mean_gap_s: float = 3600.0,
              ts: str = "timestamp", external_only: bool = True) -> DataFrame:
    """Regular connections from a source to one destination: ≥ ``min_connections``
    sessions whose inter-arrival gaps have coefficient of variation ≤ ``max_cv``.

    Gaps need time order per (src, dst). Rows are range-partitioned on
    (src, dst, ts) so a hot pair spans several partitions; gaps inside a partition
    come from a window over (partition, src, dst), the gap across a partition
    boundary from a small per-(partition, pair) first/last table. Only sums of gaps
    (count, Σg, Σg²) are aggregated per pair.
    """
    from ..functions.net import is_private_ip
    d = df.where(F.col(ts).isNotNull() & F.col("src_ip").isNotNull() & F.col("dst_ip").isNotNull())
    if external_only:
        d = d.where(is_private_ip("dst_ip") == 0)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    # checkpointed: inner gaps and boundary gaps must come from the same ranges
    d = materialize(d.select("src_ip", "dst_ip", t.alias("t")).repartitionByRange(parts, "src_ip", "dst_ip", "t")
                    .withColumn("pid", F.spark_partition_id()))
    w = Window.partitionBy("pid", "src_ip", "dst_ip").orderBy("t")
    inner = d.withColumn("g", F.col("t") - F.lag("t").over(w)).where(F.col("g").isNotNull())
    inner = inner.groupBy("src_ip", "dst_ip").agg(F.count(F.lit(1)).alias("k"), F.sum("g").alias("sg"),
                                                  F.sum(F.col("g") * F.col("g")).alias("sg2"))
    edges = d.groupBy("pid", "src_ip", "dst_ip").agg(F.min("t").alias("first"), F.max("t").alias("last"),
                                                     F.count(F.lit(1)).alias("n"))
    wp = Window.partitionBy("src_ip", "dst_ip").orderBy("pid")
    bnd = edges.withColumn("g", F.col("first") - F.lag("last").over(wp)).groupBy("src_ip", "dst_ip").agg(
        F.count("g").alias("k"), F.coalesce(F.sum("g"), F.lit(0.0)).alias("sg"),
        F.coalesce(F.sum(F.col("g") * F.col("g")), F.lit(0.0)).alias("sg2"), F.sum("n").alias("connections"))
    tot = bnd.join(inner, ["src_ip", "dst_ip"], "left").select(
        "src_ip", "dst_ip", "connections",
        (bnd.k + F.coalesce(inner.k, F.lit(0))).alias("k"),
        (bnd.sg + F.coalesce(inner.sg, F.lit(0.0))).alias("sg"),
        (bnd.sg2 + F.coalesce(inner.sg2, F.lit(0.0))).alias("sg2"))
    mean = F.col("sg") / F.col("k")
    var = F.greatest(F.col("sg2") / F.col("k") - mean * mean, F.lit(0.0))
    tot = tot.where(F.col("k") > 0).withColumn("mean_gap_s", mean).withColumn("std_gap_s", F.sqrt(var))
    tot = tot.withColumn("cv", F.try_divide(F.col("std_gap_s"), F.col("mean_gap_s")))
    return tot.where((F.col("connections") >= min_connections) & (F.col("cv") <= max_cv)
                     & (F.col("mean_gap_s") <= max_mean_gap_s)).select(
        "src_ip", "dst_ip", "connections", F.round("mean_gap_s", 6).alias("mean_gap_s"),
        F.round("std_gap_s", 6).alias("std_gap_s"), F.round("cv", 6).alias("cv"))


def vote(df: DataFrame, flags: list[str], min_votes: int | None = None, out: str = "is_anomaly") -> DataFrame:
    """Ensemble: anomaly when at least ``min_votes`` detectors flag the row (default:
    a majority). Adds ``votes``."""
    m = min_votes or (len(flags) // 2 + 1)
    votes = reduce(lambda a, b: a + b, [F.coalesce(F.col(f).cast("int"), F.lit(0)) for f in flags])
    return df.withColumn("votes", votes).withColumn(out, (F.col("votes") >= m).cast("int"))
