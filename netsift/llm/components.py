"""Connected components of an edge table by alternating large-star and small-star steps.

Both steps are a partial aggregation (least neighbour of each node) and a join; a hub's
edges collapse to one row per task before the shuffle, and the join's two sides are
separate exchanges, so a hub's edges can be split (AQE skew join). Rounds grow with the
logarithm of the longest chain; each ends in a reliable checkpoint, and the loop runs
until the edges no longer change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import persisted


def _least(links: DataFrame) -> DataFrame:
    """(u, m): the least of each node and its neighbours; ``links`` holds both directions."""
    return links.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")).select("n", F.least("n", "m").alias("m"))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node reachable, for every node of an edge."""
    e = persisted(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .filter(F.col("u") != F.col("v")).distinct())
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    state = None
    while True:
        # large star: every larger neighbour of a node links to the least around it
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(persisted(_least(both)), F.col("u") == F.col("n")).filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = persisted(large.distinct())
        # small star: a node and its smaller neighbours link to the least of them
        low = persisted(_least(large))
        j = large.join(low, F.col("u") == F.col("n"))
        small = (j.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select(F.col("n").alias("u"), F.col("m").alias("v")))
                 .filter(F.col("u") != F.col("v")).distinct())
        e = persisted(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == tuple(now):
            break
        state = tuple(now)
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
