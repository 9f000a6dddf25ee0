"""End-to-end compositions: train on one log, apply the saved models to another.

``train`` mirrors the training run: parse → drop hostname / DNS / ICMP → pair →
drop zero durations → stage → features → stage → standardiser → detectors → scores →
top-N review exports + comparison table. Everything is written under ``out_dir``
(a shared folder on a cluster); models are saved under ``out_dir/models``.

``apply`` mirrors the prediction run, but with the *saved* standardiser and feature
lookups (rare-port table, protocol codes) from training, not ones re-fitted on the new
data.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators import export as X
from ..operators import metrics as M
from ..operators.detectors import (DBSCAN, DBSCANModel, Autoencoder, AutoencoderModel, IsolationForest, IsolationForestModel,
                                   LocalOutlierFactor, LOFModel, OneClassSVM, OneClassSVMModel)
from ..operators.features import FeatureLookups, engineer_features, fit_scaler
from ..operators.sessions import drop_zero_duration, pair_sessions, prepare_events
from ..schema import DEFAULT_CONTAMINATION, TOP_EXPORT
from ..sources.files import write_csv
from ..sources.syslog import parse_syslog

LOADERS = {"isolation_forest": IsolationForestModel, "one_class_svm": OneClassSVMModel, "lof": LOFModel,
           "autoencoder": AutoencoderModel, "dbscan": DBSCANModel}


def saved_models(spark: SparkSession, model_dir: str) -> list[str]:
    """Names of the models under ``model_dir``, on any file system Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(model_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [d for d in LOADERS if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path, d))]
    if not found:
        raise FileNotFoundError(f"no saved model under {model_dir}")
    return found


def sessions_from_log(spark: SparkSession, log_path: str, year: int) -> DataFrame:
    return drop_zero_duration(pair_sessions(prepare_events(parse_syslog(spark, log_path)), year))


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def train(spark: SparkSession, log_path: str, out_dir: str, year: int,
          contamination: float = DEFAULT_CONTAMINATION, detectors: list[str] | None = None,
          top_n: int = TOP_EXPORT) -> DataFrame:
    """Train every detector on the log; returns the unsupervised comparison table."""
    detectors = detectors or ["isolation_forest", "one_class_svm", "lof", "dbscan", "autoencoder"]
    sessions = _stage(sessions_from_log(spark, log_path, year), os.path.join(out_dir, "stages", "sessions"))
    lookups = FeatureLookups.fit(sessions)
    lookups.save(os.path.join(out_dir, "models", "lookups"))
    feats = _stage(engineer_features(sessions, year, materialize_input=False, lookups=lookups),
                   os.path.join(out_dir, "stages", "features"))
    scaler = fit_scaler(feats)
    scaler.write().overwrite().save(os.path.join(out_dir, "models", "scaler"))
    matrix = _stage(scaler.transform(feats), os.path.join(out_dir, "stages", "matrix"))
    makers = {
        "isolation_forest": lambda: IsolationForest(contamination=contamination),
        "one_class_svm": lambda: OneClassSVM(nu=contamination),
        "lof": lambda: LocalOutlierFactor(contamination=contamination, id_col="session_id"),
        "autoencoder": lambda: Autoencoder(contamination=contamination),
        "dbscan": lambda: DBSCAN(id_col="session_id"),
    }
    results = []
    for name in detectors:
        detector = makers[name]()
        if hasattr(detector, "fit_transform"):  # training rows are scored once
            model, scored = detector.fit_transform(matrix)
        else:
            model = detector.fit(matrix)
            scored = model.transform(matrix)
        model.save(os.path.join(out_dir, "models", name))
        scored = _stage(scored.drop("features"), os.path.join(out_dir, "stages", f"scored_{name}"))
        X.export_top_anomalies(scored, name, os.path.join(out_dir, "exports"), top_n)
        results.append(M.unsupervised_result(scored, name))
    table = X.compare_unsupervised(results)
    write_csv(table, os.path.join(out_dir, "exports", "model_comparison.csv"), single_file=True)
    return table


def apply(spark: SparkSession, log_path: str, model_dir: str, out_dir: str, year: int,
          detectors: list[str] | None = None, top_n: int = TOP_EXPORT) -> dict[str, str]:
    """Score a new log with the saved standardiser and detectors; returns export paths."""
    detectors = detectors or saved_models(spark, model_dir)
    sessions = _stage(sessions_from_log(spark, log_path, year), os.path.join(out_dir, "stages", "sessions"))
    lookups = FeatureLookups.load(spark, os.path.join(model_dir, "lookups"))
    feats = engineer_features(sessions, year, materialize_input=False, lookups=lookups)
    scaler = PipelineModel.load(os.path.join(model_dir, "scaler"))
    matrix = _stage(scaler.transform(feats), os.path.join(out_dir, "stages", "matrix"))
    paths = {}
    for name in detectors:
        model = LOADERS[name].load(spark, os.path.join(model_dir, name))
        scored = model.transform(matrix).drop("features")
        paths[name] = X.export_top_anomalies(scored, name, os.path.join(out_dir, "exports"), top_n)
    return paths
