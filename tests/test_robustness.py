"""Odd input: ports out of range, tables without rows, events without a place in the log."""

import os

import pytest
from pyspark.sql import functions as F

from netsift.operators.detectors import (Autoencoder, AutoencoderModel, IsolationForest, IsolationForestModel, OneClassSVM,
                                         OneClassSVMModel, pca_2d)
from netsift.operators.features import engineer_features
from netsift.operators.profile import corr_matrix
from netsift.operators.sessions import drop_zero_duration, pair_sessions, prepare_events
from netsift.plans import catalog as C
from netsift.sources.syslog import parse_lines

SF = "/root/testdata/sf0.001"


def _line(t, kind, sid, port="443", src="192.0.2.1"):
    at = f"{src}/1000->198.51.100.2/{port}"
    return (f"Jan 12 {t} FW1 RT_FLOW: RT_FLOW_SESSION_{kind}: session x {at} 0x0 junos-https {at} 0x0 N/A N/A N/A N/A 6 a b c "
            f"{sid} 1(2) 3(4) 5 UNKNOWN")


def test_port_out_of_range_is_zero(spark):
    rows = [(_line("10:00:00", "CREATE", 1, "99999999999"),), (_line("10:00:09", "CLOSE", 1, "99999999999"),),
            (_line("10:00:09", "CLOSE", 2, "9" * 30),)]
    s = pair_sessions(parse_lines(spark.createDataFrame(rows, "value string")), 2024)
    got = {r.session_id: (r.dst_port, r.is_privileged_port) for r in engineer_features(s, 2024).collect()}
    assert got == {"1": (0, 1), "2": (0, 1)}


@pytest.mark.parametrize("detector, model", [(IsolationForest(), IsolationForestModel), (Autoencoder(), AutoencoderModel),
                                             (OneClassSVM(), OneClassSVMModel)])
def test_detectors_without_a_training_row(spark, scratch, detector, model):
    none = spark.createDataFrame([], "id long, features array<double>")
    m, scored = detector.fit_transform(none)
    assert scored.collect() == []
    m.save(os.path.join(scratch, "m"))
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id long, features array<double>")
    for x in (m, detector.fit(none), model.load(spark, os.path.join(scratch, "m"))):
        assert [(r.anomaly_score, r.is_anomaly) for r in x.transform(rows).collect()] == [(None, 0), (None, 0)]


def test_profile_and_pca_without_rows(spark):
    none = spark.createDataFrame([], "a double, b double")
    assert [tuple(r) for r in corr_matrix(none).collect()] == [("b", "a", None)]
    v = spark.createDataFrame([], "id long, features array<double>")
    out, ratios = pca_2d(v)
    assert out.columns == ["id", "pc1", "pc2"] and out.collect() == [] and ratios == []


def test_correlation_of_large_offsets_in_one_pass(spark):
    df = spark.range(5000).select((F.col("id") + 1e9).alias("a"), (2e9 - F.col("id") * F.col("id")).alias("b"),
                                  F.when(F.col("id") > 4000, F.sin("id")).alias("c"))
    got = {(r.col_a, r.col_b): r.corr for r in corr_matrix(df.repartition(5)).collect()}
    want = df.toPandas().corr()
    assert all(abs(v - want.loc[a, b]) < 1e-5 for (a, b), v in got.items())


def test_events_without_a_place_are_ordered_by_time(spark):
    cols = "timestamp string, event_type string, session_id string, src_ip string, dst_port int, protocol string"
    c, k = "RT_FLOW_SESSION_CREATE", "RT_FLOW_SESSION_CLOSE"
    rows = [("Jan  1 10:00:20", k, "1", "a", 80, "TCP"), ("Jan  1 10:00:05", c, "1", "a", 80, "TCP"), ("odd", c, "1", "a", 80, "TCP"),
            ("Jan  1 10:00:00", c, "1", "a", 80, "TCP"), ("Jan  1 10:00:00", c, "1", "a", 80, "TCP")]
    assert [r.duration for r in pair_sessions(spark.createDataFrame(rows, cols), 2024).collect()] == [20.0]


def test_pairing_reads_the_log_once(spark):
    lines = C.log_lines(spark, SF)
    n = lines.count()
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(v):
        read.add(1)
        return v

    events = parse_lines(lines.withColumn("value", counted.asNondeterministic()("value")))
    s = drop_zero_duration(pair_sessions(prepare_events(events), C.FIXTURE_YEAR))
    assert s.count() > 0 and s.agg(F.sum("duration")).first()[0] > 0
    assert read.value == n


def test_empty_log_through_all_stages(spark):
    none = parse_lines(spark.createDataFrame([], "value string"))
    s = drop_zero_duration(pair_sessions(prepare_events(none), 2024))
    assert s.collect() == [] and engineer_features(s, 2024).collect() == []
