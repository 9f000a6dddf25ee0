"""Anomaly detectors as Spark estimators: ``fit(df) → model``, ``model.transform(df)``
adds ``anomaly_score`` (higher = more anomalous) and ``is_anomaly`` (0/1)."""

from .autoencoder import Autoencoder, AutoencoderModel
from .base import DetectorModel
from .dbscan import DBSCAN, DBSCANModel
from .forest_table import ForestTable, ForestTableModel
from .iforest import IsolationForest, IsolationForestModel
from .ksvm import KernelOneClassSVM, KernelOneClassSVMModel
from .lof import LocalOutlierFactor, LOFModel
from .ml import DetectorStage, DetectorStageModel
from .ocsvm import OneClassSVM, OneClassSVMModel
from .pca import pca_2d
from .registry import all_detectors

__all__ = ["Autoencoder", "AutoencoderModel", "DetectorModel", "DetectorStage", "DetectorStageModel", "DBSCAN", "DBSCANModel", "ForestTable", "ForestTableModel", "IsolationForest",
           "IsolationForestModel", "KernelOneClassSVM", "KernelOneClassSVMModel", "LocalOutlierFactor", "LOFModel", "OneClassSVM", "OneClassSVMModel",
           "pca_2d", "all_detectors"]
