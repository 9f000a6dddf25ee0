"""Isolation forest.

* **Subsampling** (seeded): every (row, tree) pair is chosen with probability 2ψ/n, so ≈ 2ψ·T
  rows are kept in total whatever the input size. Draws are made on distinct vectors and
  their counts: a vector of c rows comes to a tree with probability 1 − (1 − 2ψ/n)^c, and
  the tree draws how many of its rows are meant. Equal rows so never meet in one task,
  and the draws (hashes of vector and tree) do not hang on partitioning or retries.
* **Growing**: ``groupBy(tree).applyInPandas`` — one task per tree, ≈ 2ψ rows each, of which
  it keeps ψ.
  Random feature, uniform split in the node's [min, max], depth ≤ ⌈log2 ψ⌉.
* **Scoring**: the forest (≤ T·2ψ nodes, independent of the data size) is shipped with a
  Pandas UDF over the feature column; each Arrow batch walks all trees level by level in NumPy.
  ``anomaly_score = 2^(−E[h(x)] / c(ψ))``; ``is_anomaly`` when the score exceeds the
  (1 − contamination) percentile of the training scores.
"""

from __future__ import annotations

import math
import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...schema import DEFAULT_CONTAMINATION, IFOREST_MAX_SAMPLES, IFOREST_TREES, SEED
from ..joins import materialize
from .base import Detector, DetectorModel, as_array

EULER = 0.5772156649015329


def c_factor(n):
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, size long"


def _copies(c: int, p: float, u: float) -> int:
    """How many of ``c`` equal rows are drawn, each with probability ``p``, given that one is."""
    if c <= 1 or p >= 1.0:
        return c
    mass = (1.0 - p) ** c
    target = mass + u * (1.0 - mass)
    k, below = 0, mass
    while below < target and k < c:
        mass *= (c - k) / (k + 1) * p / (1.0 - p)
        k += 1
        below += mass
    return max(k, 1)


def _grow(pdf: pd.DataFrame, psi: int, p: float, max_depth: int, seed: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    pdf = pdf.sort_values(["u", "h"])
    rng = np.random.default_rng([seed, tree])
    draws = rng.random(len(pdf))
    m = [_copies(int(c), p, float(u)) for c, u in zip(pdf["c"], draws)]
    pick = rng.permutation(np.repeat(np.arange(len(pdf)), m))[:psi]
    X = np.array(pdf["x"].tolist(), dtype=float)[pick]
    rows = []  # node, feature, split, left, right, size

    def build(idx: np.ndarray, depth: int) -> int:
        node = len(rows)
        rows.append([node, -1, 0.0, -1, -1, len(idx)])
        if depth >= max_depth or len(idx) <= 1:
            return node
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            return node
        f = int(rng.choice(cand))
        s = float(rng.uniform(lo[f], hi[f]))
        left = idx[sub[:, f] < s]
        right = idx[sub[:, f] >= s]
        rows[node][1], rows[node][2] = f, s
        rows[node][3] = build(left, depth + 1)
        rows[node][4] = build(right, depth + 1)
        return node

    if len(X):
        build(np.arange(len(X)), 0)
    out = pd.DataFrame(rows, columns=["node", "feature", "split", "left", "right", "size"])
    out.insert(0, "tree", tree)
    return out.astype({"tree": "int32", "node": "int32", "feature": "int32", "left": "int32", "right": "int32",
                       "size": "int64"})


def _uniform(*cols):
    """A number in [0, 1) from a hash of the columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)).cast("double") / float(1 << 40)


class IsolationForest(Detector):
    def __init__(self, n_trees: int = IFOREST_TREES, max_samples: int = IFOREST_MAX_SAMPLES,
                 contamination: float = DEFAULT_CONTAMINATION, seed: int = SEED, features_col: str = "features"):
        self.n_trees, self.max_samples, self.contamination = n_trees, max_samples, contamination
        self.seed, self.features_col = seed, features_col

    def _percentile(self) -> float:
        return 100.0 * (1.0 - self.contamination)

    def _train(self, df: DataFrame) -> "IsolationForestModel":
        x = df.select(as_array(df, self.features_col).alias("x")).where(F.col("x").isNotNull())
        x = x.withColumn("h", F.xxhash64("x"))
        counts = materialize(x.groupBy("h").agg(F.count(F.lit(1)).alias("c")))  # hashes only are shuffled
        n = counts.agg(F.sum("c")).first()[0] or 0
        psi = max(1, min(self.max_samples, n))
        T, seed = self.n_trees, self.seed
        p = min(1.0, 2.0 * psi / max(n, 1))                               # per (row, tree)
        q = F.lit(1.0) - F.pow(F.lit(1.0 - p), F.col("c"))                # per (vector, tree)
        f = F.least(F.lit(1.0), F.lit(float(T)) * q)                      # per vector, any tree
        kept = counts.withColumn("q", q).withColumn("f", f).where(_uniform(F.lit(seed), F.col("h")) < F.col("f"))
        pairs = materialize(kept.select("h", "c", "q", "f", F.explode(F.sequence(F.lit(0), F.lit(T - 1))).alias("tree"))
                            .withColumn("u", _uniform(F.lit(seed + 1), F.col("tree"), F.col("h")))
                            .where(F.col("u") < F.col("q") / F.col("f")).select("h", "c", "tree", "u"))
        # about 2ψT drawn pairs in all, so their hashes can be broadcast
        vectors = x.join(F.broadcast(pairs.select("h").distinct()), "h", "left_semi").dropDuplicates(["h"])
        max_depth = int(math.ceil(math.log2(max(psi, 2))))
        nodes = (pairs.join(vectors, "h").groupBy("tree")
                 .applyInPandas(lambda g: _grow(g, psi, p, max_depth, seed), NODE_SCHEMA))
        forest = nodes.toPandas()
        return IsolationForestModel({"n_trees": T, "max_samples": psi, "contamination": self.contamination,
                                     "seed": seed}, forest, features_col=self.features_col)


class IsolationForestModel(DetectorModel):
    name = "isolation_forest"

    def __init__(self, params: dict, forest: pd.DataFrame, threshold: float | None = None,
                 features_col: str = "features"):
        super().__init__(params, threshold, features_col)
        self.forest = forest.sort_values(["tree", "node"]).reset_index(drop=True)

    def _arrays(self):
        f = self.forest
        trees = sorted(f["tree"].unique())
        width = int(f.groupby("tree")["node"].max().max()) + 1 if len(f) else 1
        shape = (len(trees), width)
        feat = np.full(shape, -1, dtype=np.int64)
        split = np.zeros(shape)
        left = np.zeros(shape, dtype=np.int64)
        right = np.zeros(shape, dtype=np.int64)
        size = np.zeros(shape)
        pos = {t: i for i, t in enumerate(trees)}
        ti = f["tree"].map(pos).to_numpy()
        ni = f["node"].to_numpy()
        feat[ti, ni] = f["feature"].to_numpy()
        split[ti, ni] = f["split"].to_numpy()
        left[ti, ni] = f["left"].to_numpy()
        right[ti, ni] = f["right"].to_numpy()
        size[ti, ni] = f["size"].to_numpy()
        return feat, split, left, right, size

    def matrix_scorer(self):
        if not len(self.forest):
            return None
        feat, split, left, right, size = self._arrays()
        leaf_adj = c_factor(size)
        cpsi = float(c_factor([self.params["max_samples"]])[0]) or 1.0

        def run(X: np.ndarray) -> np.ndarray:
            b = len(X)
            total = np.zeros(b)
            rows = np.arange(b)
            for t in range(feat.shape[0]):
                node = np.zeros(b, dtype=np.int64)
                depth = np.zeros(b)
                while True:
                    f = feat[t, node]
                    active = f >= 0
                    if not active.any():
                        break
                    go_left = X[rows, np.where(active, f, 0)] < split[t, node]
                    nxt = np.where(go_left, left[t, node], right[t, node])
                    node = np.where(active, nxt, node)
                    depth += active
                total += depth + leaf_adj[t, node]
            return np.power(2.0, -(total / feat.shape[0]) / cpsi)

        return run

    def _tables(self):
        return {"forest": self._spark().createDataFrame(self.forest, NODE_SCHEMA)}

    @classmethod
    def load(cls, spark, path: str) -> "IsolationForestModel":
        meta = DetectorModel.read_meta(spark, path)
        forest = spark.read.parquet(os.path.join(path, "forest")).toPandas()
        return cls(meta["params"], forest, meta["threshold"], meta["features_col"])
