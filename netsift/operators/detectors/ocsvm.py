"""One-class SVM with an RBF kernel, approximated by random Fourier features.

z(x) = √(2/D)·cos(Wx + b), W ~ N(0, 2γ), b ~ U(0, 2π), γ = 1 / (d · Var(X)) (the
"scale" rule; one aggregate pass). In feature space the linear one-class objective
½‖w‖² − ρ + 1/(νn) Σ max(0, ρ − w·z) is minimised by data-parallel subgradient
rounds (``training.run_round``), so every row is used — no 50 000-row cap. ρ is then
set to the ν-quantile of the training margins (the ν-property of the exact solution).
Score = −w·z(x) (higher = more anomalous); anomaly when w·z(x) < ρ.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...schema import DEFAULT_CONTAMINATION, SEED
from ..joins import materialize
from .base import Detector, DetectorModel, as_array
from .training import held, pack, run_round, shards


def rff(X, W, b):
    z, scale = X @ W, np.sqrt(2.0 / W.shape[1])
    for s in range(0, len(z), 256):  # in place, while a part is in the cache
        part = z[s:s + 256]
        part += b
        np.cos(part, out=part)
        part *= scale
    return z


class OneClassSVM(Detector):
    def __init__(self, nu: float = DEFAULT_CONTAMINATION, n_components: int = 300, gamma: float | None = None,
                 rounds: int = 30, batch: int = 256, lr: float = 0.05, min_steps: int = 50, seed: int = SEED,
                 features_col: str = "features"):
        self.nu, self.D, self.gamma, self.rounds, self.batch, self.lr = nu, n_components, gamma, rounds, batch, lr
        self.min_steps = min_steps
        self.seed, self.features_col = seed, features_col

    def _percentile(self) -> float:
        return 100.0 * (1.0 - self.nu)

    def _train(self, df: DataFrame) -> "OneClassSVMModel":
        x = materialize(df.select(as_array(df, self.features_col).alias("x")).where(F.col("x").isNotNull()))
        row = x.first()
        if row is None:  # no training row: a model that scores nothing
            return OneClassSVMModel({"nu": self.nu, "gamma": self.gamma, "n_components": self.D}, np.zeros((0, self.D)),
                                    np.zeros(self.D), np.zeros(self.D), float("-inf"), features_col=self.features_col)
        d = len(row["x"])
        if self.gamma is None:
            per = [(F.sum(F.get("x", i)), F.sum(F.get("x", i) * F.get("x", i))) for i in range(d)]
            row = x.agg(F.count(F.lit(1)), *(c for pair in per for c in pair)).first()
            n = row[0] * d
            var = max(sum(row[2::2]) / n - (sum(row[1::2]) / n) ** 2, 0.0) or 1.0
            gamma = 1.0 / (d * var) if var > 0 else 1.0
        else:
            gamma = self.gamma
        rng = np.random.default_rng(self.seed)
        W = rng.normal(0.0, np.sqrt(2.0 * gamma), (d, self.D))
        b = rng.uniform(0.0, 2 * np.pi, self.D)
        nu, batch, lr0, seed, min_steps = self.nu, self.batch, self.lr, self.seed, self.min_steps

        def local(wr, X, rnd):  # wr = [w..., rho]
            r = np.random.default_rng([seed, rnd, len(X)])
            w, rho = wr[:-1], wr[-1]
            Z = X  # Fourier features: the round maps the rows
            lr = lr0 / np.sqrt(1.0 + rnd)
            passes = max(1, -(-min_steps // max(1, -(-len(Z) // batch))))  # ≥ min_steps updates per round
            for _ in range(passes):
                order = r.permutation(len(Z))
                for s in range(0, len(Z), batch):
                    zb = Z[order[s:s + batch]]
                    viol = (zb @ w) < rho
                    gw = w - (zb[viol].sum(axis=0) / (nu * len(zb)))
                    grho = -1.0 + viol.sum() / (nu * len(zb))
                    w, rho = w - lr * gw, rho - lr * grho
            return np.concatenate([w, [rho]])

        def loss(wr, Z):
            if len(Z) == 0:
                return np.zeros(0)
            return np.maximum(0.0, wr[-1] - Z @ wr[:-1]) / nu - wr[-1]

        data = pack(shards(x, 0.0, self.seed))  # the rows, ten times narrower than their Fourier features
        wr = np.concatenate([np.full(self.D, 1.0 / np.sqrt(self.D)), [0.0]])
        with held(data):
            for rnd in range(self.rounds):
                wr, _, _ = run_round(data, wr, local, loss, rnd, lambda m: rff(m, W, b))
        params = {"nu": nu, "gamma": gamma, "n_components": self.D}
        return OneClassSVMModel(params, W, b, wr[:-1], float(wr[-1]), features_col=self.features_col)


class OneClassSVMModel(DetectorModel):
    name = "one_class_svm"

    def __init__(self, params, W, b, w, rho, features_col="features"):
        super().__init__(params, -rho, features_col)
        self.W, self.b, self.w, self.rho = np.asarray(W), np.asarray(b), np.asarray(w), float(rho)

    def set_threshold(self, threshold: float) -> None:
        # ν-property: ρ is the ν-quantile of the training margins w·z (exact, distributed)
        self.rho, self.threshold = -threshold, threshold

    def matrix_scorer(self):
        W, b, w = self.W, self.b, self.w
        return (lambda x: -(rff(x, W, b) @ w)) if len(W) else None

    def _tables(self):
        pdf = pd.DataFrame({"proj": [self.W.ravel().tolist()], "phase": [self.b.tolist()],
                            "weights": [self.w.tolist()], "d": [self.W.shape[0]], "rho": [self.rho]})
        return {"state": self._spark().createDataFrame(
            pdf, "proj array<double>, phase array<double>, weights array<double>, d long, rho double")}

    @classmethod
    def load(cls, spark, path: str) -> "OneClassSVMModel":
        meta = DetectorModel.read_meta(spark, path)
        r = spark.read.parquet(os.path.join(path, "state")).first()
        d = int(r["d"])
        W = np.array(r["proj"], float).reshape(d, len(r["phase"]))
        m = cls(meta["params"], W, np.array(r["phase"]), np.array(r["weights"]), float(r["rho"]), meta["features_col"])
        m.threshold = meta["threshold"]
        return m
