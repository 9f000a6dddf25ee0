"""Detectors as Spark ML stages: params, ``Pipeline``, and saving with ``write()`` / ``load``.

``DetectorStage(detector="lof", contamination=0.05)`` is an ``Estimator`` for any detector of
``DETECTORS``; fitting gives a ``DetectorStageModel``, a ``Model`` that adds ``anomaly_score`` and
``is_anomaly``. Both are ``MLWritable``, so a ``Pipeline`` of standardiser, assembler and
detectors is fitted, saved and loaded as one.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame

from ...schema import DEFAULT_CONTAMINATION
from .autoencoder import Autoencoder, AutoencoderModel
from .base import DetectorModel
from .dbscan import DBSCAN, DBSCANModel
from .forest_table import ForestTable, ForestTableModel
from .iforest import IsolationForest, IsolationForestModel
from .ksvm import KernelOneClassSVM, KernelOneClassSVMModel
from .lof import LocalOutlierFactor, LOFModel
from .ocsvm import OneClassSVM, OneClassSVMModel

# name: (detector from contamination, features column, id column and options; model class)
DETECTORS = {
    "isolation_forest": (lambda c, f, i, o: IsolationForest(contamination=c, features_col=f, **o), IsolationForestModel),
    "forest_table": (lambda c, f, i, o: ForestTable(contamination=c, features_col=f, id_col=i, **o), ForestTableModel),
    "one_class_svm": (lambda c, f, i, o: OneClassSVM(nu=c, features_col=f, **o), OneClassSVMModel),
    "kernel_svm": (lambda c, f, i, o: KernelOneClassSVM(nu=c, features_col=f, **o), KernelOneClassSVMModel),
    "autoencoder": (lambda c, f, i, o: Autoencoder(contamination=c, features_col=f, **o), AutoencoderModel),
    "lof": (lambda c, f, i, o: LocalOutlierFactor(contamination=c, features_col=f, id_col=i, **o), LOFModel),
    "dbscan": (lambda c, f, i, o: DBSCAN(features_col=f, id_col=i, **o), DBSCANModel),
}


class _DetectorParams(HasFeaturesCol):
    detector = Param(Params._dummy(), "detector", "name of the detector", typeConverter=TypeConverters.toString)
    contamination = Param(Params._dummy(), "contamination", "share of rows taken as anomalies", typeConverter=TypeConverters.toFloat)
    idCol = Param(Params._dummy(), "idCol", "column of unique row ids", typeConverter=TypeConverters.toString)
    options = Param(Params._dummy(), "options", "further arguments of the detector, as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(detector="isolation_forest", contamination=DEFAULT_CONTAMINATION, featuresCol="features", idCol="id",
                         options="{}")


class DetectorStage(Estimator, _DetectorParams, DefaultParamsWritable, DefaultParamsReadable):
    @keyword_only
    def __init__(self, *, detector="isolation_forest", contamination=DEFAULT_CONTAMINATION, featuresCol="features", idCol="id",
                 options="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "DetectorStageModel":
        name = self.getOrDefault("detector")
        make, _ = DETECTORS[name]
        fitted = make(self.getOrDefault("contamination"), self.getFeaturesCol(), self.getOrDefault("idCol"),
                      json.loads(self.getOrDefault("options"))).fit(dataset)
        return self._copyValues(DetectorStageModel(fitted))


class DetectorStageModel(Model, _DetectorParams, MLWritable, MLReadable):
    def __init__(self, fitted: DetectorModel | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.transform(dataset)

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, stage: DetectorStageModel):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.fitted.save(f"{path}/detector")


class _ModelReader(MLReader):
    def load(self, path: str) -> DetectorStageModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = DetectorStageModel()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.fitted = DETECTORS[stage.getOrDefault("detector")][1].load(self.sparkSession, f"{path}/detector")
        return stage
