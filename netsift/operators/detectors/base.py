"""Shared detector plumbing: vector → array, threshold fitting, persistence."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..joins import materialize
from ..quantiles import exact_quantiles


def as_array(df: DataFrame, features_col: str = "features") -> F.Column:
    """The feature column as ``array<double>`` (vectors or arrays accepted)."""
    dt = df.schema[features_col].dataType
    if isinstance(dt, T.ArrayType):
        return F.col(features_col).cast("array<double>")
    return vector_to_array(F.col(features_col))


def with_score(df: DataFrame, features_col: str, fn: Callable[[np.ndarray], np.ndarray] | None) -> DataFrame:
    """``df`` with ``anomaly_score``: ``fn`` of the feature matrix of each Arrow batch. Only the
    features are sent to Python; the other columns stay in the JVM. A null vector has no score,
    and a model that saw no training row (``fn`` is None) scores none."""
    if fn is None:
        return df.withColumn("anomaly_score", F.lit(None).cast("double"))

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        known = x.notna().to_numpy()
        out = np.full(len(x), np.nan)
        if known.any():
            out[known] = fn(np.array(x[known].tolist(), dtype=float))
        return pd.Series(out).where(known, None)

    # not deterministic for the optimiser: a filter on the score must not run it a second time
    return df.withColumn("anomaly_score", score.asNondeterministic()(as_array(df, features_col)))


def fit_threshold(scores: DataFrame, col: str, pct: float) -> float:
    """Exact ``pct``-th percentile of training scores (one scalar to the driver)."""
    row = exact_quantiles(scores, col, [pct / 100.0]).first()
    return float(row[0]) if row and row[0] is not None else float("inf")


class DetectorModel:
    """Base for fitted detectors; subclasses implement ``score`` and the state tables."""

    name = "detector"

    def __init__(self, params: dict, threshold: float | None = None, features_col: str = "features"):
        self.params = dict(params)
        self.threshold = threshold
        self.features_col = features_col

    # -- scoring ---------------------------------------------------------
    def matrix_scorer(self) -> Callable[[np.ndarray], np.ndarray] | None:
        """Scores of a feature matrix, for models that score rows one by one (None: no training row)."""
        raise NotImplementedError

    def score(self, df: DataFrame) -> DataFrame:
        return with_score(df, self.features_col, self.matrix_scorer())

    def set_threshold(self, threshold: float) -> None:
        self.threshold = threshold

    def transform(self, df: DataFrame) -> DataFrame:
        return self.flag(self.score(df))

    def flag(self, s: DataFrame) -> DataFrame:
        """``is_anomaly`` for scored rows."""
        flag = F.col("anomaly_score") > F.lit(self.threshold)
        return s.withColumn("is_anomaly", F.coalesce(flag.cast("int"), F.lit(0)))

    # -- persistence -----------------------------------------------------
    def _meta(self) -> dict:
        return {"class": type(self).__name__, "params": self.params, "threshold": self.threshold,
                "features_col": self.features_col}

    def save(self, path: str) -> str:
        spark = self._spark()
        meta = spark.createDataFrame([(json.dumps(self._meta()),)], "meta string")
        meta.coalesce(1).write.mode("overwrite").text(os.path.join(path, "meta"))
        for name, table in self._tables().items():
            table.write.mode("overwrite").parquet(os.path.join(path, name))
        return path

    @staticmethod
    def read_meta(spark, path: str) -> dict:
        return json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])

    def _tables(self) -> dict:
        return {}

    def _spark(self):
        from pyspark.sql import SparkSession
        return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()  # a thread may have none active


class Detector:
    """Base of detectors whose threshold is a percentile of the training scores; subclasses
    implement ``_train`` (a model without threshold) and ``_percentile``."""

    features_col = "features"

    def _train(self, df: DataFrame) -> DetectorModel:  # pragma: no cover - abstract
        raise NotImplementedError

    def _percentile(self) -> float:  # pragma: no cover - abstract
        raise NotImplementedError

    def fit(self, df: DataFrame) -> DetectorModel:
        model = self._train(df)
        model.set_threshold(fit_threshold(model.score(df.select(self.features_col)), "anomaly_score", self._percentile()))
        return model

    def fit_transform(self, df: DataFrame) -> tuple[DetectorModel, DataFrame]:
        """The model and the flagged training rows, scored once (checkpointed)."""
        model = self._train(df)
        scored = materialize(model.score(df))
        model.set_threshold(fit_threshold(scored, "anomaly_score", self._percentile()))
        return model, model.flag(scored)
