"""Isolation forest as relations: grown and scored by joins and aggregations, no Python on executors.

* **Draws.** Every random number is a hash (MD5) of seed, tree and row id or node, so any SQL
  engine grows the same forest from the same rows. Rows are thinned once by a hash of their
  id, then drawn per tree, so the hashes made per tree do not grow with the data; each
  tree keeps its ``max_samples`` smallest draws.
* **Growing**, level by level for all trees at once: per node the least and largest value of
  each feature (one aggregation), a feature among those that vary and a split between its
  bounds by hashes, then the rows go to child 2·node or 2·node + 1. What a level reads is
  trees × samples × features values, whatever the size of the data; levels are checkpointed.
* **The model** is a table of nodes (tree, node, feature, split, size), at most two per sample.
* **Scoring** walks a level per broadcast join of that level's splits, for all trees of a row;
  a row's paths are summed before anything is shuffled. The score is 2^(−mean path / c).

Null vectors are not drawn and have no score; rows equal in id and vector have one score; without a training row nothing has a score.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ...schema import DEFAULT_CONTAMINATION, IFOREST_MAX_SAMPLES, IFOREST_TREES, SEED
from ..joins import materialize
from .base import Detector, DetectorModel, as_array
from .iforest import c_factor

SPARE = 4  # draws of a tree, times its samples, before the smallest are kept
NODE_TABLE = "tree int, node long, depth int, feature int, split double, size long"


def hash_unit(*parts) -> Column:
    """A number in [0, 1) from the first 32 bits of the MD5 of the parts, joined by '-'."""
    text = F.concat_ws("-", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)


class ForestTable(Detector):
    def __init__(self, n_trees: int = IFOREST_TREES, max_samples: int = IFOREST_MAX_SAMPLES,
                 contamination: float = DEFAULT_CONTAMINATION, seed: int = SEED, features_col: str = "features", id_col: str = "id"):
        self.n_trees, self.max_samples, self.contamination = n_trees, max_samples, contamination
        self.seed, self.features_col, self.id_col = seed, features_col, id_col

    def _percentile(self) -> float:
        return 100.0 * (1.0 - self.contamination)

    def fit(self, df: DataFrame) -> "ForestTableModel":
        return self.fit_transform(df)[0]

    def _train(self, df: DataFrame) -> "ForestTableModel":
        t, psi, seed = self.n_trees, self.max_samples, self.seed
        rows = df.select(F.col(self.id_col).cast("string").alias("id"), as_array(df, self.features_col).alias("x")) \
            .where(F.col("x").isNotNull())
        n = rows.count()
        params = {"n_trees": t, "max_samples": min(psi, n), "contamination": self.contamination, "seed": seed,
                  "id_col": self.id_col}
        any_tree = min(1.0, SPARE * psi * t / max(n, 1))
        one_tree = min(1.0, SPARE * psi / max(n, 1)) / any_tree
        thin = rows.where(hash_unit(seed, "*", F.col("id")) < any_tree)
        drawn = (thin.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(t - 1))))
                 .withColumn("u", hash_unit(seed, F.col("tree"), F.col("id"))).where(F.col("u") < one_tree))
        w = Window.partitionBy("tree").orderBy("u", "id")  # about SPARE × samples rows a tree
        at = materialize(drawn.withColumn("k", F.row_number().over(w)).where(F.col("k") <= psi)
                         .select("tree", F.lit(1).cast("long").alias("node"), "x"))
        nodes = None
        for depth in range(max(1, math.ceil(math.log2(max(params["max_samples"], 2))))):
            spread = (at.select("tree", "node", F.posexplode("x").alias("feature", "v")).groupBy("tree", "node", "feature")
                      .agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where(F.col("hi") > F.col("lo")))
            order = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("tree"), F.col("node"), F.col("feature")))
            best = spread.groupBy("tree", "node").agg(F.min_by(F.struct("feature", "lo", "hi"), order).alias("b"))
            u = hash_unit(seed, F.col("tree"), F.col("node"))
            splits = materialize(best.select("tree", "node", F.lit(depth).alias("depth"), F.col("b.feature").alias("feature"),
                                             (F.col("b.lo") + u * (F.col("b.hi") - F.col("b.lo"))).alias("split")))
            nodes = splits if nodes is None else nodes.unionByName(splits)
            at = materialize(_step(at, splits).select("tree", "node", "x"))
        leaves = at.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("size"))
        none = F.lit(None)
        table = nodes.withColumn("size", none.cast("long")).unionByName(
            leaves.select("tree", "node", none.cast("int").alias("depth"), none.cast("int").alias("feature"),
                          none.cast("double").alias("split"), "size"))
        return ForestTableModel(params, materialize(table), features_col=self.features_col)


def _step(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """``rows`` (tree, node, x, ...) with ``node`` moved to its child, and ``moved``, where it is split."""
    s = splits.select(F.col("tree").alias("s_tree"), F.col("node").alias("s_node"), "feature", "split")
    j = rows.join(F.broadcast(s), (F.col("tree") == F.col("s_tree")) & (F.col("node") == F.col("s_node")), "left")
    right = (F.get("x", F.col("feature")) >= F.col("split")).cast("long")
    moved = F.col("split").isNotNull()
    return (j.withColumn("moved", moved).withColumn("node", F.when(moved, 2 * F.col("node") + right).otherwise(F.col("node")))
            .drop("s_tree", "s_node", "feature", "split"))


class ForestTableModel(DetectorModel):
    name = "forest_table"

    def __init__(self, params: dict, nodes: DataFrame, threshold: float | None = None, features_col: str = "features"):
        super().__init__(params, threshold, features_col)
        self.nodes = nodes

    def paths(self, rows: DataFrame) -> DataFrame:
        """(id, path): the mean path length of each (id, x) row."""
        depths = [r["depth"] for r in self.nodes.where("depth IS NOT NULL").select("depth").distinct().orderBy("depth").collect()]
        walk = (rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(self.params["n_trees"] - 1))))
                .withColumn("node", F.lit(1).cast("long")).withColumn("h", F.lit(0)))
        for d in depths:
            walk = _step(walk, self.nodes.where(F.col("depth") == d)).withColumn("h", F.col("h") + F.col("moved").cast("int")).drop("moved")
        largest = int(self.params["max_samples"])
        sizes = self.nodes.where("size IS NOT NULL").select(F.col("tree").alias("l_tree"), F.col("node").alias("l_node"), "size")
        rest = F.get(F.array(*(F.lit(float(c)) for c in c_factor(range(largest + 1)))), F.coalesce("size", F.lit(0)).cast("int"))
        leaf = F.broadcast(sizes)  # at most one row per sample
        ends = walk.join(leaf, (F.col("tree") == F.col("l_tree")) & (F.col("node") == F.col("l_node")), "left")
        return ends.groupBy("id").agg(F.avg(F.col("h") + rest).alias("path"))

    def score(self, df: DataFrame) -> DataFrame:
        c = float(c_factor([self.params["max_samples"]])[0]) or 1.0
        rows = df.select(F.col(self.params["id_col"]).cast("string").alias("id"), as_array(df, self.features_col).alias("x"))
        rows = rows.where(F.col("x").isNotNull() & F.lit(self.params["max_samples"] > 0))
        s = self.paths(rows).select(F.col("id").alias("__id"), F.pow(F.lit(2.0), -F.col("path") / c).alias("anomaly_score"))
        return df.join(s, F.col(self.params["id_col"]).cast("string").eqNullSafe(F.col("__id")), "left").drop("__id")

    def _tables(self):
        return {"nodes": self.nodes}

    @classmethod
    def load(cls, spark, path: str) -> "ForestTableModel":
        meta = DetectorModel.read_meta(spark, path)
        nodes = spark.read.schema(NODE_TABLE).parquet(os.path.join(path, "nodes"))
        return cls(meta["params"], nodes, meta["threshold"], meta["features_col"])
