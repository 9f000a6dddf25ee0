"""Dense autoencoder (d-64-32-8-32-64-d, ReLU, dropout 0.2, linear output, MSE, Adam).

Training is data-parallel (``training.run_round``): each round every partition does one
local epoch of mini-batch Adam (batch 256) from the broadcast weights; the weights are
averaged by row count. Early stopping watches the hash-held-out validation loss
(patience 5) and keeps the best weights. NumPy forward/backward only — no deep-learning
runtime is needed on executors. Score = per-row reconstruction MSE; anomaly when the
error is above the ``threshold_percentile`` of the training errors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...schema import (AE_BATCH, AE_DROPOUT, AE_ENCODING, AE_EPOCHS, AE_HIDDEN, AE_PATIENCE, AE_VALIDATION,
                       DEFAULT_CONTAMINATION, SEED)
from .base import Detector, DetectorModel, as_array
from .training import held, pack, run_round, shards


def layer_sizes(d: int, hidden=AE_HIDDEN, enc=AE_ENCODING) -> list[int]:
    return [d, *hidden, enc, *reversed(hidden), d]


def unpack(w: np.ndarray, sizes: list[int]):
    out, i = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        W = w[i:i + a * b].reshape(a, b); i += a * b
        bb = w[i:i + b]; i += b
        out.append((W, bb))
    return out


def init_weights(sizes: list[int], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        lim = np.sqrt(6.0 / (a + b))  # Glorot uniform
        parts += [rng.uniform(-lim, lim, a * b), np.zeros(b)]
    return np.concatenate(parts)


# dropout follows the first encoder layers and the first decoder layer
def _dropout_after(n_layers: int) -> set[int]:
    return {0, 1, 3} if n_layers == 6 else set()


def forward(w, sizes, X, rng=None, p=0.0):
    layers = unpack(w, sizes)
    drop = _dropout_after(len(layers))
    acts, masks = [X], []
    h = X
    for li, (W, b) in enumerate(layers):
        z = h @ W + b
        last = li == len(layers) - 1
        h = z if last else np.maximum(z, 0.0)
        m = None
        if rng is not None and p > 0 and li in drop:
            m = (rng.random(h.shape) >= p) / (1.0 - p)
            h = h * m
        masks.append(m)
        acts.append(h)
    return acts, masks


def recon_error(w, sizes, X):
    if len(X) == 0:
        return np.zeros(0)
    acts, _ = forward(w, sizes, X)
    return np.mean((X - acts[-1]) ** 2, axis=1)


def local_epoch_fn(sizes, batch, p, seed, lr=1e-3):
    """One local epoch of Adam; its batches share one set of arrays."""
    n_layers, drop = len(sizes) - 1, _dropout_after(len(sizes) - 1) if p > 0 else set()
    up = 1.0 / (1.0 - p)

    def run(state, X, round_no):
        rng = np.random.default_rng([seed, round_no, len(X)])
        # one optimiser over all rounds: its moments travel with the weights
        w, m, v = (part.copy() for part in np.split(state, 3))
        g, a, c = np.empty_like(w), np.empty_like(w), np.empty_like(w)
        layers, grads = unpack(w, sizes), unpack(g, sizes)  # views
        t = round_no * -(-len(X) // batch)
        order = rng.permutation(len(X))
        rows = min(batch, len(X))
        space = [[np.empty((rows, k)) for k in sizes] for _ in range(2)]
        draws = {li: np.empty((rows, sizes[li + 1])) for li in drop}
        gates = {li: np.empty((rows, sizes[li + 1]), bool) for li in range(n_layers - 1)}
        for s in range(0, len(X), batch):
            n = min(batch, len(X) - s)
            acts, deltas = ([part[:n] for part in parts] for parts in space)
            np.take(X, order[s:s + n], axis=0, out=acts[0], mode="clip")
            for li, (W, b) in enumerate(layers):
                h = np.matmul(acts[li], W, out=acts[li + 1])
                h += b
                if li < n_layers - 1:
                    np.maximum(h, 0.0, out=h)
                if li in drop:
                    keep = np.greater_equal(rng.random(out=draws[li][:n]), p, out=gates[li][:n])
                    h *= keep
                    h *= up
            delta = np.subtract(acts[-1], acts[0], out=deltas[-1])
            delta *= 2.0
            delta /= n * sizes[-1]
            for li in range(n_layers - 1, -1, -1):
                gw, gb = grads[li]
                np.matmul(acts[li].T, delta, out=gw)
                np.sum(delta, axis=0, out=gb)
                if li > 0:
                    delta = np.matmul(delta, layers[li][0].T, out=deltas[li])
                    if li - 1 in drop:  # a dropped activation is 0, so the gate shuts it too
                        delta *= up
                    delta *= np.greater(acts[li], 0, out=gates[li - 1][:n])
            t += 1
            # w -= lr * (m / (1 - 0.9 ** t)) / (sqrt(v / (1 - 0.999 ** t)) + 1e-7)
            m *= 0.9
            m += np.multiply(g, 0.1, out=a)
            v *= 0.999
            np.multiply(g, 0.001, out=a)
            v += np.multiply(a, g, out=a)
            np.divide(v, 1 - 0.999 ** t, out=c)
            np.sqrt(c, out=c)
            c += 1e-7
            np.divide(m, 1 - 0.9 ** t, out=a)
            a *= lr
            a /= c
            w -= a
        return np.concatenate([w, m, v])
    return run


class Autoencoder(Detector):
    def __init__(self, encoding_dim: int = AE_ENCODING, threshold_percentile: float | None = None,
                 contamination: float = DEFAULT_CONTAMINATION, epochs: int = AE_EPOCHS, batch_size: int = AE_BATCH,
                 validation_split: float = AE_VALIDATION, patience: int = AE_PATIENCE, dropout: float = AE_DROPOUT,
                 seed: int = SEED, features_col: str = "features"):
        self.encoding_dim = encoding_dim
        self.threshold_percentile = threshold_percentile if threshold_percentile is not None \
            else 100.0 * (1.0 - contamination)
        self.epochs, self.batch, self.val, self.patience = epochs, batch_size, validation_split, patience
        self.dropout, self.seed, self.features_col = dropout, seed, features_col

    def _percentile(self) -> float:
        return self.threshold_percentile

    def _train(self, df: DataFrame) -> "AutoencoderModel":
        x = df.select(as_array(df, self.features_col).alias("x")).where(F.col("x").isNotNull())
        row = x.first()
        if row is None:  # no training row: a model that scores nothing
            return AutoencoderModel({"sizes": [], "threshold_percentile": self.threshold_percentile, "epochs_run": 0,
                                     "val_loss": []}, np.zeros(0), features_col=self.features_col)
        d = len(row["x"])
        sizes = layer_sizes(d, AE_HIDDEN, self.encoding_dim)
        data = pack(shards(x, self.val, self.seed))
        w = init_weights(sizes, self.seed)
        k = len(w)
        w = np.concatenate([w, np.zeros(2 * k)])
        step = local_epoch_fn(sizes, self.batch, self.dropout, self.seed)
        loss = lambda ww, X: recon_error(ww[:k], sizes, X)
        best, best_loss, bad, history = w, float("inf"), 0, []
        with held(data):
            for epoch in range(self.epochs + 1):
                new, vl, _ = run_round(data, w, step, loss, epoch)  # vl = validation loss of `w`
                if epoch > 0:
                    history.append(vl)
                    if vl < best_loss - 1e-12:
                        best, best_loss, bad = w, vl, 0
                    else:
                        bad += 1
                        if bad >= self.patience:
                            break
                if epoch == self.epochs:
                    break
                w = new
        return AutoencoderModel({"sizes": sizes, "threshold_percentile": self.threshold_percentile,
                                 "epochs_run": len(history), "val_loss": history}, best[:k],
                                features_col=self.features_col)


class AutoencoderModel(DetectorModel):
    name = "autoencoder"

    def __init__(self, params, weights: np.ndarray, threshold=None, features_col="features"):
        super().__init__(params, threshold, features_col)
        self.weights = np.asarray(weights, dtype=float)

    def matrix_scorer(self):
        sizes, w = self.params["sizes"], self.weights
        return (lambda x: recon_error(w, sizes, x)) if sizes else None

    def _tables(self):
        return {"weights": self._spark().createDataFrame(pd.DataFrame({"w": [self.weights.tolist()]}), "w array<double>")}

    @classmethod
    def load(cls, spark, path: str) -> "AutoencoderModel":
        import os
        meta = DetectorModel.read_meta(spark, path)
        w = np.array(spark.read.parquet(os.path.join(path, "weights")).first()["w"])
        return cls(meta["params"], w, meta["threshold"], meta["features_col"])
