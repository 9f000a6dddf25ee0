"""One-class SVM with an RBF kernel, Nyström features and a certified duality gap.

*Features.* ``landmarks`` rows are drawn by ridge leverage scores from a sample of bounded size
(rows chosen by a hash): rows that the others span badly are more likely. With the
landmarks' kernel matrix K, z(x) = K^(-1/2) k(x) is the Nyström map, and z(x)·z(y) is the
kernel within the landmarks' span; ``approximation`` is the mean of k(x, x) - |z(x)|² over the
rows, the part of a row's kernel that the map loses.

*Dual.* A dual point is a weighting of the rows with weights in [0, 1 / (ν n)] that sum to 1; its
mean w = Σ a_i z_i is the normal of the plane, and the SVM is the w of least norm. Every
round adds an atom: the weighting that puts full weight on the νn rows of smallest
margin w·z (found exactly up to a bin of a margin histogram, which one distributed pass
counts and a second one averages). The least-norm mixture of all atoms (a small problem on
the driver, over at most ``rounds`` vectors) is the next w. Mixtures of atoms are dual feasible,
and |w|² - w·atom (plus a bin) bounds how far |w|² is from the optimum: the rounds stop
when this gap is below ``tol`` of |w|².

*Scale.* A round reads packed shards (as the other trained models) twice; the driver receives a
histogram and one vector. The model is the landmarks and one weight per landmark.

Null vectors are not trained on and have no score; without a training row nothing has a score.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...schema import DEFAULT_CONTAMINATION, SEED
from .base import Detector, DetectorModel, as_array
from .training import SUM_GROUPS, pack, shards

SAMPLE = 2048
BINS = 1 << 14


def rbf(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.exp(-gamma * np.maximum(d, 0))


def ridge_leverage(k: np.ndarray, ridge: float) -> np.ndarray:
    """Diagonal of K (K + ridge I)^-1."""
    val, vec = np.linalg.eigh(k)
    val = np.maximum(val, 0)
    return (vec * vec) @ (val / (val + ridge))


def nystrom_map(landmarks: np.ndarray, gamma: float) -> np.ndarray:
    """K^(-1/2) of the landmarks (directions of no weight are left out)."""
    val, vec = np.linalg.eigh(rbf(landmarks, landmarks, gamma))
    keep = val > 1e-10 * val.max()
    return vec[:, keep] / np.sqrt(val[keep])


def least_norm(atoms: np.ndarray, steps: int = 4000) -> np.ndarray:
    """Weights (not negative, sum 1) of the mixture of least norm, by pairwise steps on the Gram matrix."""
    g = atoms @ atoms.T
    a = np.zeros(len(g))
    a[int(np.diag(g).argmin())] = 1.0
    for _ in range(steps):
        grad = g @ a
        to = int(grad.argmin())
        held = np.flatnonzero(a > 0)
        away = int(held[grad[held].argmax()])
        if grad[away] - grad[to] <= 1e-14 * max(grad[away], 1e-300):
            break
        curve = g[to, to] + g[away, away] - 2 * g[to, away]
        step = min(a[away], (grad[away] - grad[to]) / max(curve, 1e-300))
        a[to] += step
        a[away] -= step
    return a / a.sum()


class KernelOneClassSVM(Detector):
    def __init__(self, nu: float = DEFAULT_CONTAMINATION, gamma: float | None = None, landmarks: int = 256, rounds: int = 40,
                 tol: float = 0.01, seed: int = SEED, features_col: str = "features"):
        self.nu, self.gamma, self.landmarks, self.rounds, self.tol = nu, gamma, landmarks, rounds, tol
        self.seed, self.features_col = seed, features_col

    def _percentile(self) -> float:
        return 100.0 * (1.0 - self.nu)

    def _sample(self, x: DataFrame) -> np.ndarray:
        """At most SAMPLE rows, the least by a hash."""
        rows = x.orderBy(F.xxhash64(F.lit(self.seed), "x"), "x").limit(SAMPLE).toPandas()
        return np.unique(np.array(rows["x"].tolist(), dtype=float), axis=0) if len(rows) else np.zeros((0, 0))

    def _train(self, df: DataFrame) -> "KernelOneClassSVMModel":
        x = df.select(as_array(df, self.features_col).alias("x")).where(F.col("x").isNotNull())
        sample = self._sample(x)
        if not len(sample):
            return KernelOneClassSVMModel({"nu": self.nu, "gap": 0.0, "norm2": 0.0, "approximation": 0.0}, np.zeros((0, 0)), np.zeros(0), features_col=self.features_col)
        gamma = self.gamma or 1.0 / (sample.shape[1] * (sample.var() or 1.0))
        rng = np.random.default_rng(self.seed)
        lev = ridge_leverage(rbf(sample, sample, gamma), len(sample) / (4 * self.landmarks))
        keys = np.log(np.maximum(lev, 1e-300)) + rng.gumbel(size=len(lev))  # without replacement, by leverage
        marks = sample[np.sort(np.argsort(-keys, kind="stable")[:self.landmarks])]
        root = nystrom_map(marks, gamma)
        data = pack(shards(x, 0.0, self.seed), lambda m: rbf(m, marks, gamma) @ root)
        dim, nu = root.shape[1], self.nu
        n, mean, norm = self._sums(data, dim, lambda z: np.ones(len(z)))
        atoms, w, gap = [mean / n], mean / n, np.inf
        for _ in range(self.rounds):
            atom, width = self._atom(data, dim, w, nu * n)
            gap = float(w @ w - w @ atom) + width
            if gap <= self.tol * float(w @ w):
                break
            atoms.append(atom)
            mix = least_norm(np.array(atoms))
            w = mix @ np.array(atoms)
            atoms = [a for a, m in zip(atoms, mix) if m > 0] + ([] if mix[-1] > 0 else [atom])
        params = {"nu": nu, "gamma": gamma, "gap": max(gap, 0.0), "norm2": float(w @ w), "approximation": 1.0 - norm / n}
        return KernelOneClassSVMModel(params, marks, root @ w, features_col=self.features_col)

    @staticmethod
    def _pass(data: DataFrame, fn, size: int) -> np.ndarray:
        """Sum of the vectors ``fn(z, m)`` of all shards, added in two levels."""
        def go(batches):
            for pdf in batches:
                for row in pdf.itertuples():
                    z = np.frombuffer(row.x, float).reshape(-1, row.d)
                    yield pd.DataFrame({"v": [fn(z, np.frombuffer(row.m, np.int64)).tolist()]})

        parts = data.mapInPandas(go, "v array<double>").select(array_to_vector("v").alias("v"), (F.spark_partition_id() % SUM_GROUPS).alias("g"))
        total = Summarizer.sum(F.col("v")).alias("v")
        out = parts.groupBy("g").agg(total).agg(total).first()["v"].toArray()
        assert len(out) == size
        return out

    def _sums(self, data: DataFrame, dim: int, weight) -> tuple[float, np.ndarray, float]:
        """Rows, sum of their maps, sum of their squared norms."""
        def fn(z, m):
            return np.concatenate([[m.sum()], m @ z, [float(m @ (z * z).sum(axis=1))]])
        out = self._pass(data, fn, dim + 2)
        return float(out[0]), out[1:-1], float(out[-1])

    def _atom(self, data: DataFrame, dim: int, w: np.ndarray, tail: float) -> tuple[np.ndarray, float]:
        """Mean map of the ``tail`` rows of smallest margin, and the width of the histogram's bins."""
        most = float(np.sqrt(w @ w)) * (1 + 1e-9)  # |z| is at most 1
        width = 2 * most / BINS

        def place(z):
            return np.clip(((z @ w + most) / width).astype(np.int64), 0, BINS - 1)

        counts = self._pass(data, lambda z, m: np.bincount(place(z), m, BINS), BINS)
        below = np.cumsum(counts)
        last = int(np.searchsorted(below, tail))
        share = (tail - (below[last] - counts[last])) / counts[last]  # of the rows in the last bin

        def fn(z, m):
            b = place(z)
            return (m * ((b < last) + share * (b == last))) @ z
        return self._pass(data, fn, dim) / tail, width


class KernelOneClassSVMModel(DetectorModel):
    name = "kernel_svm"

    def __init__(self, params, landmarks: np.ndarray, weights: np.ndarray, threshold=None, features_col="features"):
        super().__init__(params, threshold, features_col)
        self.landmarks, self.weights = np.asarray(landmarks, float), np.asarray(weights, float)

    def matrix_scorer(self):
        marks, v, gamma = self.landmarks, self.weights, self.params.get("gamma")
        return (lambda x: -(rbf(x, marks, gamma) @ v)) if len(marks) else None

    def _tables(self):
        rows = [(i, r.tolist(), float(w)) for i, (r, w) in enumerate(zip(self.landmarks, self.weights))]
        return {"landmarks": self._spark().createDataFrame(rows, "i int, x array<double>, w double")}

    @classmethod
    def load(cls, spark, path: str) -> "KernelOneClassSVMModel":
        meta = DetectorModel.read_meta(spark, path)
        rows = sorted(spark.read.parquet(os.path.join(path, "landmarks")).collect(), key=lambda r: r["i"])
        return cls(meta["params"], np.array([r["x"] for r in rows]), np.array([r["w"] for r in rows]), meta["threshold"], meta["features_col"])
