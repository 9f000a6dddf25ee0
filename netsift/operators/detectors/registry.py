"""Detector registry: every detector with the shared contamination."""

from __future__ import annotations

from ...schema import DEFAULT_CONTAMINATION
from .autoencoder import Autoencoder
from .dbscan import DBSCAN
from .iforest import IsolationForest
from .lof import LocalOutlierFactor
from .ocsvm import OneClassSVM


def all_detectors(contamination: float = DEFAULT_CONTAMINATION, id_col: str = "session_id") -> dict:
    """Isolation forest, one-class SVM (ν = contamination), LOF, DBSCAN, autoencoder
    (threshold percentile 100·(1 − contamination), not truncated)."""
    return {
        "isolation_forest": IsolationForest(contamination=contamination),
        "one_class_svm": OneClassSVM(nu=contamination),
        "lof": LocalOutlierFactor(contamination=contamination, id_col=id_col),
        "dbscan": DBSCAN(id_col=id_col),
        "autoencoder": Autoencoder(contamination=contamination),
    }
