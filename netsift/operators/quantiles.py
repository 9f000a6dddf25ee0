"""Exact quantiles that stay distributed.

``F.percentile`` is exact but merges a value→count map of *all* distinct values in
one task; on 100 TB of byte counts that map does not fit. Here:

1. ``groupBy(group, value).count()`` — distributed, a hot value collapses to one row;
2. ``repartitionByRange`` on (group, value), checkpointed so that totals and ranks read the
   same ranges; per-(partition, group) totals (a few rows per partition) and prefix offsets
   over those rows, attached by a join (broadcast only within a bound);
3. a window **within** each range partition gives the global cumulative count;
4. the rows holding ranks ⌊h⌋ and ⌈h⌉ (h = (n-1)·p) are kept and interpolated
   linearly — the same definition as NumPy / pandas / DuckDB ``quantile_cont``.

``grouped_quantiles`` does this for many groups (e.g. several columns in long form)
in one pass; ``exact_quantiles`` is the one-column case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .joins import attach_lookup, materialize


def grouped_quantiles(long: DataFrame, group: str, value: str, probs: list[float], prefix: str = "q",
                      partitions: int | None = None, one_group: bool = False) -> DataFrame:
    """(group, value) rows → one row per group with ``<prefix><i>`` per probability.

    ``one_group`` tells that there is a single group, so that the offsets are one row per
    partition; otherwise their size is checked before they are broadcast.
    """
    spark = long.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    vals = long.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")) \
        .where(F.col("v").isNotNull() & ~F.isnan("v"))
    d = vals.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    d = materialize(d.repartitionByRange(parts, "g", "v").withColumn("pid", F.spark_partition_id()))
    totals = d.groupBy("g", "pid").agg(F.sum("c").alias("pc"))
    # offsets over (group, partition) rows: at most groups × partitions rows
    offs = totals.select(
        "g", "pid",
        F.coalesce(F.sum("pc").over(Window.partitionBy("g").orderBy("pid")
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"),
        F.sum("pc").over(Window.partitionBy("g")).alias("n"))
    d = d.join(F.broadcast(offs), ["g", "pid"]) if one_group else attach_lookup(d, offs, ["g", "pid"], "inner")
    w = Window.partitionBy("pid", "g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("cum", F.col("off") + F.sum("c").over(w))
    d = d.withColumn("start", F.col("cum") - F.col("c"))  # 0-based ranks start .. cum-1 hold v
    picks = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        picks.append(F.struct(
            F.min(F.when((F.col("start") <= lo) & (lo < F.col("cum")), F.col("v"))).alias("a"),
            F.min(F.when((F.col("start") <= hi) & (hi < F.col("cum")), F.col("v"))).alias("b"),
            F.first(h - lo, ignorenulls=True).alias("frac")).alias(f"_s{i}"))
    r = d.groupBy("g").agg(*picks)
    return r.select(F.col("g").alias(group),
                    *[(F.col(f"_s{i}.a") + (F.col(f"_s{i}.b") - F.col(f"_s{i}.a")) * F.col(f"_s{i}.frac"))
                      .alias(f"{prefix}{i}") for i in range(len(probs))])


def exact_quantiles(df: DataFrame, col: str, probs: list[float], prefix: str = "q",
                    partitions: int | None = None) -> DataFrame:
    """One row with ``<prefix><i>`` per probability (NULL when there are no values)."""
    long = df.select(F.lit(0).alias("_g"), F.col(col).alias("_v"))
    q = grouped_quantiles(long, "_g", "_v", probs, prefix, partitions, one_group=True)
    one = df.sparkSession.range(1).select(F.lit(0).alias("_g"))
    return one.join(q, "_g", "left").drop("_g")
