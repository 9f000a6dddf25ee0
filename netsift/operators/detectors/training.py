"""Data-parallel training rounds for small dense models (autoencoder, one-class SVM).

Equal rows are counted first and dealt to shards in lots of at most ``LOT`` copies by a hash of
their values and the lot's number, so that a vector that holds a third of all rows is spread
over the shards like any other. The number of shards follows from the number of rows (about
``SHARD_ROWS`` each), and rows are ordered within a shard. Shards are dealt to partitions by
their numbers, so no partition holds more than one shard above another. A shard is packed into
one row, its matrix as bytes, training rows first; the packed table is checkpointed once, and
``held`` by the executors (in memory, else on their disks) while the rounds read it. A fixed feature map may be
applied before packing (rounds map nothing again) or in each round (``run_round``; a map that
widens rows, such as random Fourier features, would be read back many times as wide). One round = one Spark job: the current state (weights, and the optimiser's moments)
travels in the task closure, every shard runs one local epoch of mini-batch updates, and the
states are averaged, weighted by rows. A fitted model so depends on
the rows only, not on how the input was split. A task computes on one shard at a time and returns
one vector; the driver receives one per round, summed in two levels. Validation lots are chosen by the
same hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..joins import materialize

ROUND_SCHEMA = "n long, wsum array<double>, vloss double, vn long"


SHARD_ROWS = 12_800
LOT = 1_600
SUM_GROUPS = 32
BATCH_BYTES = "4m"  # a shard or two: batches of 32m took about three times as long to reach Python


def shards(x: DataFrame, validation: float, seed: int) -> DataFrame:
    """(shard, is_val, x, m): lots of ``m`` equal rows of array column ``x``, dealt and ordered by a hash."""
    x = materialize(x.groupBy("x").agg(F.count(F.lit(1)).alias("c")))
    k = max(1, -(-(x.agg(F.sum("c")).first()[0] or 0) // SHARD_ROWS))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1, F.lit(LOT).cast("long"))).alias("lot")
    lots = x.select("x", "c", first).withColumn("m", F.least(F.lit(LOT).cast("long"), F.col("c") - F.col("lot")))
    h = F.xxhash64(F.lit(seed), F.col("x"), F.col("lot"))
    rows = lots.select(F.pmod(F.xxhash64(h), F.lit(k)).cast("int").alias("shard"), h.alias("h"),
                       (F.pmod(h, F.lit(1_000_000)) < int(validation * 1_000_000)).alias("is_val"), "m", "x")
    n = min(k, int(x.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartitionById(n, F.col("shard") % n).sortWithinPartitions("shard", "h", "x").select("shard", "is_val", "x", "m")


def pack(rows: DataFrame, feature_map: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(shard, d, x, m, is_val): one row per shard of ``shards``, its columns as bytes, the rows for
    validation last (checkpointed)."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def one(key: int, parts: list[pd.DataFrame]) -> pd.DataFrame:
        pdf = pd.concat(parts).sort_values("is_val", kind="stable")
        x = np.array(pdf["x"].tolist(), dtype=float)
        x = x if feature_map is None else feature_map(x)
        return pd.DataFrame({"shard": [key], "d": [x.shape[1]], "x": [np.ascontiguousarray(x).tobytes()],
                             "m": [pdf["m"].to_numpy(np.int64).tobytes()], "is_val": [pdf["is_val"].to_numpy(bool).tobytes()]})

    def go(batches):
        held, at = [], None  # the rows of one shard; shards follow one another
        for pdf in batches:
            for key, part in pdf.groupby("shard", sort=True):
                if held and key != at:
                    yield one(at, held)
                    held = []
                at = key
                held.append(part)
        if held:
            yield one(at, held)

    return materialize(rows.mapInPandas(go, "shard int, d int, x binary, m binary, is_val binary"))


@contextmanager
def held(data: DataFrame) -> Iterator[DataFrame]:
    """``data`` kept by the executors; a lost part is read from the checkpoint again."""
    data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield data
    finally:
        data.unpersist()


def run_round(data: DataFrame, state: np.ndarray,
              local_epoch: Callable[[np.ndarray, np.ndarray, int], np.ndarray],
              loss: Callable[[np.ndarray, np.ndarray], np.ndarray], round_no: int,
              feature_map: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, float, int]:
    """One synchronous round over packed shards, whose distinct rows are mapped first; returns (averaged state,
    validation loss of ``state``, train rows)."""
    s0 = state.copy()

    def shard(d: int, x: pa.Buffer, m: pa.Buffer, is_val: pa.Buffer) -> tuple[np.ndarray, int, float, int]:
        m = np.frombuffer(m, np.int64)
        X = np.frombuffer(x, float).reshape(-1, d)
        X = X if feature_map is None else feature_map(X)
        k = len(m) - int(np.frombuffer(is_val, bool).sum())
        parts = [(X[:k], m[:k]), (X[k:], m[k:])]
        tr, va = (np.repeat(z, c, axis=0) if (c > 1).any() else z for z, c in parts)
        w = local_epoch(s0.copy(), tr, round_no) if len(tr) else s0
        vl = float(loss(s0, va).sum()) if len(va) else 0.0
        return w, len(tr), vl, len(va)

    def part(batches):
        wsum, n, vloss, vn = np.zeros(len(s0)), 0, 0.0, 0
        for b in batches:
            for i in range(b.num_rows):
                w, k, vl, v = shard(b.column("d")[i].as_py(), *(b.column(c)[i].as_buffer() for c in ("x", "m", "is_val")))
                wsum += w * k
                n, vloss, vn = n + k, vloss + vl, vn + v
        if n or vn:
            w = pa.ListArray.from_arrays(pa.array([0, len(wsum)], pa.int32()), pa.array(wsum))
            yield pa.RecordBatch.from_arrays([pa.array([n]), w, pa.array([vloss]), pa.array([vn])], ["n", "wsum", "vloss", "vn"])

    r = data.mapInArrow(part, ROUND_SCHEMA)
    sums = [Summarizer.sum(F.col("w")).alias("w"), *(F.sum(c).alias(c) for c in ("n", "vloss", "vn"))]
    parts = r.select(array_to_vector("wsum").alias("w"), "n", "vloss", "vn",
                     (F.spark_partition_id() % SUM_GROUPS).alias("g"))
    # two levels: the last task adds SUM_GROUPS vectors, however many tasks there are
    agg = parts.groupBy("g").agg(*sums).agg(*sums).first()
    n = int(agg["n"] or 0)
    new = (agg["w"].toArray() / n) if n else state
    vl = (agg["vloss"] / agg["vn"]) if agg["vn"] else float("nan")
    return new, vl, n
