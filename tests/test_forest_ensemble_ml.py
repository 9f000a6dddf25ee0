"""Relational forest, ensemble, ML stages and observed accounting."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Observation
from pyspark.sql import functions as F

from netsift.operators import ensemble
from netsift.operators.detectors import (Autoencoder, KernelOneClassSVM, KernelOneClassSVMModel, DetectorStage, DetectorStageModel, ForestTable, ForestTableModel, IsolationForest,
                                         OneClassSVM)
from netsift.operators.detectors.iforest import c_factor
from netsift.operators.threats import network_scan, pane_length, port_scan
from netsift.plans import catalog as C
from netsift.sources.syslog import observed_parse

RNG = np.random.default_rng(3)
X = np.vstack([RNG.normal(size=(300, 4)), RNG.normal(size=(6, 4)) * 0.1 + 12])


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(X)), "features": list(X)})).repartition(4)


def _walk(nodes, x, n_trees):
    """Mean path of one row by following the node table."""
    splits = {(r.tree, r.node): (r.feature, r.split) for r in nodes if r.split is not None}
    size = {(r.tree, r.node): r["size"] for r in nodes if r["size"] is not None}
    total = 0.0
    for t in range(n_trees):
        node, h = 1, 0
        while (t, node) in splits:
            f, s = splits[t, node]
            node, h = 2 * node + (x[f] >= s), h + 1
        total += h + float(c_factor([size.get((t, node), 0)])[0])
    return total / n_trees


def test_forest_table_paths_and_outliers(spark, frame, scratch):
    m, scored = ForestTable(n_trees=12, max_samples=32, contamination=0.02).fit_transform(frame)
    nodes = m.nodes.collect()
    roots = {r.tree: 0 for r in nodes}
    for r in nodes:
        if r["size"] is not None:
            roots[r.tree] += r["size"]
    assert set(roots.values()) == {32} and len(roots) == 12
    got = {r.id: r.anomaly_score for r in scored.collect()}
    for i in (0, 17, 150, 303):
        assert got[i] == pytest.approx(2 ** (-_walk(nodes, X[i], 12) / float(c_factor([32])[0])))
    assert set(sorted(got, key=got.get)[-6:]) == set(range(300, 306))
    m.save(os.path.join(scratch, "f"))
    again = ForestTableModel.load(spark, os.path.join(scratch, "f")).transform(frame)
    assert {r.id: (r.anomaly_score, r.is_anomaly) for r in again.collect()} == {r.id: (r.anomaly_score, r.is_anomaly) for r in scored.collect()}
    plan = m.score(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_forest_table_is_independent_of_partitioning_and_of_nulls(spark, frame):
    f = ForestTable(n_trees=5, max_samples=16)
    a = {tuple(r) for r in f.fit(frame).nodes.collect()}
    more = frame.repartition(9).unionByName(spark.createDataFrame([(1000, None)], frame.schema))
    m = f.fit(more)
    assert {tuple(r) for r in m.nodes.collect()} == a
    assert [(r.anomaly_score, r.is_anomaly) for r in m.transform(more).where("id = 1000").collect()] == [(None, 0)]
    none = f.fit(frame.limit(0)).transform(frame.limit(3)).collect()
    assert [(r.anomaly_score, r.is_anomaly) for r in none] == [(None, 0)] * 3


def test_percent_ranks_with_ties_and_nulls(spark):
    v = [3.0, 1.0, 1.0, None, 2.0, 3.0, 3.0]
    df = spark.createDataFrame(list(enumerate(v)), "id int, s double").repartition(3)
    got = {r.id: r.r for r in ensemble.percent_ranks(df, "s", "r").collect()}
    have = [x for x in v if x is not None]
    assert got == {i: None if x is None else sum(y < x for y in have) / (len(have) - 1) for i, x in enumerate(v)}
    one = ensemble.percent_ranks(df.limit(0).unionByName(spark.createDataFrame([(1, 5.0)], df.schema)), "s", "r").collect()
    assert one[0].r == 0.0 and ensemble.percent_ranks(df.limit(0), "s", "r").collect() == []


def test_vote_counts_and_missing_rows(spark):
    cols = "id int, anomaly_score double, is_anomaly int"
    parts = {"a": [(1, 0.1, 0), (2, 0.9, 1), (3, 0.5, 1)], "b": [(1, 5.0, 1), (2, 7.0, 1), (3, 1.0, 0)], "c": [(1, 1.0, 0), (2, 2.0, 1)]}
    got = {r.id: r for r in ensemble.vote({k: spark.createDataFrame(v, cols) for k, v in parts.items()}).collect()}
    assert {i: (r.n_votes, r.is_anomaly) for i, r in got.items()} == {1: (1, 0), 2: (3, 1), 3: (1, 0)}
    assert got[2].mean_rank == 1.0 and got[3].mean_rank == pytest.approx(0.25) and got[1].mean_rank == pytest.approx((0 + 0.5 + 0) / 3)


def test_one_pass_scores_all_matrix_models(spark, frame):
    models = {"forest": IsolationForest(n_trees=10).fit(frame), "svm": OneClassSVM(rounds=2).fit(frame),
              "ae": Autoencoder(epochs=2).fit(frame)}
    rows = frame.unionByName(spark.createDataFrame([(1000, None)], frame.schema))
    got = {r.id: r for r in ensemble.score_all(rows, models).collect()}
    for n, m in models.items():
        alone = {r.id: (r.anomaly_score, r.is_anomaly) for r in m.transform(rows).collect()}
        for i, (s, f) in alone.items():
            assert got[i][f"flag_{n}"] == f and (got[i][f"score_{n}"] == s if s is None else got[i][f"score_{n}"] == pytest.approx(s))
    plan = ensemble.score_all(rows, models)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_detectors_in_one_saved_pipeline(spark, scratch):
    cols = [f"x{i}" for i in range(4)]
    df = spark.createDataFrame(pd.DataFrame(X, columns=cols).assign(id=np.arange(len(X))))
    stages = [VectorAssembler(inputCols=cols, outputCol="raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True),
              DetectorStage(detector="forest_table", contamination=0.02, options='{"n_trees": 6, "max_samples": 32}')]
    model = Pipeline(stages=stages).fit(df)
    model.write().overwrite().save(os.path.join(scratch, "p"))
    again = PipelineModel.load(os.path.join(scratch, "p"))
    last = again.stages[-1]
    assert isinstance(last, DetectorStageModel) and last.getOrDefault("contamination") == 0.02 and last.uid == model.stages[-1].uid
    pick = lambda m: {r.id: (r.anomaly_score, r.is_anomaly) for r in m.transform(df).collect()}
    assert pick(model) == pick(again)
    Pipeline(stages=stages).write().overwrite().save(os.path.join(scratch, "e"))
    assert Pipeline.load(os.path.join(scratch, "e")).getStages()[-1].getOrDefault("detector") == "forest_table"


def test_observed_accounting_costs_no_pass(spark):
    lines = C.log_lines(spark, "/root/testdata/sf0.001").select("value").unionByName(
        spark.createDataFrame([("noise",), ("RT_FLOW but no event",), (None,)], "value string"))
    seen = Observation("seen")
    n = observed_parse(lines, seen).count()
    got = seen.get
    assert got["n_parsed"] == n and (got["n_no_rt_flow"], got["n_no_match"]) == (2, 1)
    assert sum(v for k, v in got.items() if k.startswith("n_RT_FLOW")) == n


@pytest.mark.parametrize("window, slide", [("10 minutes", "5 minutes"), ("10 minutes", "4 minutes"), ("1 hour", "1 hour")])
def test_panes_give_the_windows_of_rows(spark, window, slide):
    rows = [(f"2024-01-01 00:{m:02d}:{s:02d}", f"10.0.0.{m % 2}", m * s % 7, None if s % 3 == 0 else f"h{s % 5}")
            for m in range(60) for s in (0, 13, 59)]
    df = spark.createDataFrame(rows, "t string, src_ip string, dst_port int, dst_ip string").withColumn("timestamp", F.col("t").cast("timestamp"))
    w = F.window("timestamp", window, slide).alias("w")
    for fn, target, name in ((port_scan, "dst_port", "distinct_ports"), (network_scan, "dst_ip", "distinct_hosts")):
        want = {(r.s, r.src_ip): (r.d, r.n) for r in df.groupBy(w, "src_ip").agg(
            F.count_distinct(target).alias("d"), F.count(F.lit(1)).alias("n")).where("d >= 2").select("w.start", "src_ip", "d", "n")
            .toDF("s", "src_ip", "d", "n").collect()}
        for approx in (False, True):
            got = {(r.window_start, r.src_ip): (r[name], r.connections) for r in fn(df, window, slide, 2, approx=approx).collect()}
            assert got == want
    assert pane_length("10 minutes", "4 minutes") == "120 seconds"


def _exact_dual(k, nu, steps=200_000):
    """Least a'Ka with 0 <= a <= 1 / (nu n) and sum 1, by pairwise steps on the whole kernel matrix."""
    n = len(k)
    top = 1 / (nu * n)
    a = np.full(n, 1 / n)
    g = k @ a
    for _ in range(steps):
        to = int(np.where(a < top - 1e-15, g, np.inf).argmin())
        away = int(np.where(a > 1e-15, g, -np.inf).argmax())
        if g[away] - g[to] < 1e-10:
            break
        step = min((g[away] - g[to]) / max(k[to, to] + k[away, away] - 2 * k[to, away], 1e-12), a[away], top - a[to])
        a[to] += step
        a[away] -= step
        g += step * (k[:, to] - k[:, away])
    return a


def test_kernel_svm_against_the_exact_solution(spark, frame, scratch):
    from netsift.operators.detectors.ksvm import rbf
    m, scored = KernelOneClassSVM(nu=0.1, gamma=0.3, landmarks=len(X), tol=0.002, rounds=80).fit_transform(frame)
    k = rbf(X, X, 0.3)
    a = _exact_dual(k, 0.1)
    best = float(a @ k @ a)
    p = m.params
    assert abs(p["approximation"]) < 1e-6 and 0 <= p["gap"] <= 0.002 * p["norm2"]
    assert best - 1e-9 <= p["norm2"] <= best + 2 * p["gap"] + 1e-9
    got = {r.id: (r.anomaly_score, r.is_anomaly) for r in scored.collect()}
    bound = np.sqrt(2 * p["gap"]) + 1e-6  # |w - w*|, and |z| <= 1
    assert all(abs(got[i][0] + (k @ a)[i]) <= bound for i in got)
    assert sum(f for _, f in got.values()) <= 0.1 * len(X) + 1
    m.save(os.path.join(scratch, "k"))
    again = KernelOneClassSVMModel.load(spark, os.path.join(scratch, "k")).transform(frame)
    assert {r.id: (r.anomaly_score, r.is_anomaly) for r in again.collect()} == got


def test_kernel_svm_with_few_landmarks_and_no_rows(spark, frame):
    m = KernelOneClassSVM(nu=0.1, landmarks=40).fit(frame.unionByName(spark.createDataFrame([(1000, None)], frame.schema)))
    again = KernelOneClassSVM(nu=0.1, landmarks=40).fit(frame.repartition(7))
    assert np.allclose(m.weights, again.weights) and 0 < m.params["approximation"] < 0.5
    assert m.params["gap"] <= 0.01 * m.params["norm2"]
    none = KernelOneClassSVM().fit(frame.limit(0)).transform(frame.limit(2)).collect()
    assert [(r.anomaly_score, r.is_anomaly) for r in none] == [(None, 0)] * 2


def test_constant_column_is_not_scaled_by_a_rounding_error(spark):
    """Merging the partitions of a constant column gives a variance above zero; a new value is not divided by it."""
    from netsift.operators.features import fit_scaler
    x = spark.range(0, 196, 1, 4).select(F.lit(1.0).alias("a"), F.col("id").cast("double").alias("b"))
    m = fit_scaler(x, ["a", "b"])
    got = m.transform(spark.createDataFrame([(0.0, 97.5), (1.0, 97.5)], "a double, b double")).orderBy("a")
    assert [[round(v, 9) for v in r["features"]] for r in got.collect()] == [[-1.0, 0.0], [0.0, 0.0]]
