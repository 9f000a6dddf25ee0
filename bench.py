"""Benchmark: headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``; prints one JSON line.

Setup (not timed): the RT_FLOW log is rendered from ``events`` into several text files
in a fresh scratch folder (the raw input a user would have). Timed stages read that
log and the parquet tables and materialise their results (write / collect), so each
number is a complete job.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from netsift.operators import export as X  # noqa: E402
from netsift.operators import metrics as M  # noqa: E402
from netsift.operators import profile as P  # noqa: E402
from netsift.operators import threats as TH  # noqa: E402
from netsift.operators.detectors import DBSCAN, Autoencoder, IsolationForest, LocalOutlierFactor, OneClassSVM  # noqa: E402
from netsift.operators.features import engineer_features, fit_scaler  # noqa: E402
from netsift.operators.sessions import drop_zero_duration, pair_sessions, prepare_events  # noqa: E402
from netsift.plans import catalog as C  # noqa: E402
from netsift.session import get_spark  # noqa: E402
from netsift.sources.syslog import parse_syslog  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="run-bench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    spark = get_spark(app="netsift-bench", master=f"local[{cpus}]", shuffle_partitions=2 * cpus,
                      extra={"spark.driver.memory": "16g",
                             "spark.eventLog.enabled": "true",
                             "spark.eventLog.dir": scratch})
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    year = C.FIXTURE_YEAR
    log_dir = os.path.join(scratch, "log")
    C.log_lines(spark, sf_dir).repartition(2 * cpus).sortWithinPartitions("ord").select("value") \
        .write.text(log_dir)

    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    def noop(df):
        df.write.mode("overwrite").format("noop").save()

    # a fixed job that reads no data: rounds on hosts of different speed are compared by it
    timed("yardstick", lambda: spark.range(0, 60_000_000, 1, 2 * cpus).agg(F.sum(F.xxhash64("id") % 1000)).collect())
    yardstick = times.pop("yardstick")

    timed("parse", lambda: noop(parse_syslog(spark, log_dir)))

    sess_path = os.path.join(scratch, "sessions")

    def pairing():
        ev = prepare_events(parse_syslog(spark, log_dir))
        drop_zero_duration(pair_sessions(ev, year)).write.parquet(sess_path)
    timed("pair_sessions", pairing)

    feat_path = os.path.join(scratch, "features")
    timed("features", lambda: engineer_features(spark.read.parquet(sess_path), year, materialize_input=False)
          .write.parquet(feat_path))
    feats = spark.read.parquet(feat_path)

    mat_path = os.path.join(scratch, "matrix")

    def matrix():
        model = fit_scaler(feats)
        model.transform(feats).select("session_id", "features").write.parquet(mat_path)
    timed("feature_matrix", matrix)
    mat = spark.read.parquet(mat_path)

    timed("profile", lambda: [d.collect() for d in (
        P.basic_stats(feats), P.traffic_timeline(feats, "hour"), P.activity_pivot(feats), P.histograms(feats),
        P.histograms(feats, log1p=True), P.top_values(feats), P.iqr_outliers(feats),
        P.corr_matrix(feats))])

    def metrics():
        lab = C.table(spark, sf_dir, "labels").join(C.table(spark, sf_dir, "documents")
                                                    .select("doc_id", "n_chars"), "doc_id")
        lab = M.flag_above(lab.select(F.col("toxic").alias("y"), F.col("n_chars").cast("double").alias("score")),
                           "score", 95.0, out="pred")
        lab = lab.checkpoint()
        return [d.collect() for d in (M.prf(lab), M.ranking_metrics(lab), M.roc_points(lab),
                                      M.class_report(lab), M.score_density(lab, "score", "y"))]
    timed("metrics", metrics)

    timed("threats", lambda: [d.collect() for d in (
        TH.ddos(feats, "1 hour", 2, 60), TH.port_scan(feats, "1 day", "12 hours", 4),
        TH.network_scan(feats, "1 day", "12 hours", 4), TH.exfiltration(feats, 90.0, 0.5),
        TH.beaconing(feats, 2, 1.0, 2592000.0))])

    def iforest():
        _, flagged = IsolationForest(contamination=0.05).fit_transform(mat)
        scored = flagged.join(feats, "session_id")
        return X.top_anomalies(scored).collect(), X.anomaly_summary(scored).collect()
    timed("iforest_fit_score_export", iforest)

    timed("autoencoder_fit_score", lambda: Autoencoder(contamination=0.05).fit_transform(mat)[1]
          .agg(F.sum("is_anomaly")).collect())
    timed("ocsvm_fit_score", lambda: OneClassSVM(nu=0.05).fit_transform(mat)[1].agg(F.sum("is_anomaly")).collect())

    emb = C.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"),
                                                     F.col("embedding").cast("array<double>").alias("features"))
    timed("lof_embeddings", lambda: LocalOutlierFactor(20, 0.05).fit_transform(emb)[1]
          .agg(F.sum("is_anomaly")).collect())
    timed("dbscan_embeddings", lambda: DBSCAN(1.2, 10).fit_predict(emb).agg(F.sum("is_anomaly")).collect())

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf,
                      "cpus": cpus, "yardstick_sec": yardstick}))
    spark.stop()


if __name__ == "__main__":
    main()
