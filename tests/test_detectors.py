import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from netsift.operators.detectors import (DBSCAN, Autoencoder, AutoencoderModel, IsolationForest,
                                         IsolationForestModel, LocalOutlierFactor, OneClassSVM, OneClassSVMModel)


def _blob(spark, n=400, d=5, outliers=6, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(0, 1, (n, d))
    X[:outliers] += 12.0
    pdf = pd.DataFrame({"id": np.arange(n), "features": [list(r) for r in X]})
    return spark.createDataFrame(pdf, "id long, features array<double>"), X


def test_isolation_forest_ranks_planted_outliers_and_roundtrips(spark, scratch):
    df, _ = _blob(spark)
    m = IsolationForest(n_trees=50, contamination=0.02).fit(df)
    s = m.transform(df).orderBy(F.desc("anomaly_score")).limit(6).collect()
    assert {r.id for r in s} == set(range(6))
    rate = m.transform(df).agg(F.avg("is_anomaly")).first()[0]
    assert 0.01 <= rate <= 0.04
    m.save(scratch + "/if")
    m2 = IsolationForestModel.load(spark, scratch + "/if")
    a = {r.id: r.anomaly_score for r in m.transform(df).collect()}
    b = {r.id: r.anomaly_score for r in m2.transform(df).collect()}
    assert a == b and m2.threshold == m.threshold


def _lof_brute(X, k):
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    n = len(X)
    excl = np.array([[j for j in np.lexsort((np.arange(n), D[i])) if j != i][:k] for i in range(n)])
    kdist = D[np.arange(n), excl[:, -1]]
    lrd = 1 / (np.array([np.maximum(kdist[excl[i]], D[i, excl[i]]).mean() for i in range(n)]) + 1e-10)
    inc = np.array([np.lexsort((np.arange(n), D[i]))[:k] for i in range(n)])
    lrd_q = 1 / (np.array([np.maximum(kdist[inc[i]], D[i, inc[i]]).mean() for i in range(n)]) + 1e-10)
    return np.array([lrd[inc[i]].mean() for i in range(n)]) / lrd_q


def test_lof_exact_against_brute_force(spark):
    df, X = _blob(spark, n=150, d=4, outliers=3, seed=2)
    m = LocalOutlierFactor(n_neighbors=10, contamination=0.05).fit(df)
    got = {r.id: r.anomaly_score for r in m.transform(df).collect()}
    want = _lof_brute(X, 10)
    assert np.allclose([got[i] for i in range(len(X))], want, rtol=1e-9, atol=1e-9)
    _, s2 = LocalOutlierFactor(n_neighbors=10, contamination=0.05).fit_transform(df)
    got2 = {r.id: (r.anomaly_score, r.is_anomaly) for r in s2.collect()}
    assert np.allclose([got2[i][0] for i in range(len(X))], want, rtol=1e-9, atol=1e-9)
    flags = {r.id: r.is_anomaly for r in m.transform(df).collect()}
    assert all(flags[i] == got2[i][1] for i in range(len(X)))


def test_dbscan_core_and_noise_against_brute_force(spark):
    df, X = _blob(spark, n=200, d=3, outliers=5, seed=4)
    eps, ms = 0.8, 6
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    deg = (D <= eps).sum(1)
    core = deg >= ms
    noise = ~core & ~((D <= eps) & core[None, :]).any(1)
    r = {x.id: x for x in DBSCAN(eps=eps, min_samples=ms).fit_predict(df).collect()}
    assert all(r[i].degree == deg[i] for i in range(len(X)))
    assert all(bool(r[i].is_core) == core[i] for i in range(len(X)))
    assert all(bool(r[i].is_anomaly) == noise[i] for i in range(len(X)))


def test_ocsvm_rate_and_outliers(spark, scratch):
    df, _ = _blob(spark, n=400, d=4, outliers=4, seed=5)
    m = OneClassSVM(nu=0.05, rounds=15).fit(df)
    s = m.transform(df)
    rate = s.agg(F.avg("is_anomaly")).first()[0]
    assert 0.01 <= rate <= 0.15
    assert s.where("id < 4").agg(F.min("is_anomaly")).first()[0] == 1
    m.save(scratch + "/oc")
    m2 = OneClassSVMModel.load(spark, scratch + "/oc")
    assert np.allclose(sorted(r.anomaly_score for r in m2.score(df).collect()),
                       sorted(r.anomaly_score for r in m.score(df).collect()))


def test_autoencoder_threshold_and_roundtrip(spark, scratch):
    df, _ = _blob(spark, n=300, d=6, outliers=3, seed=6)
    m = Autoencoder(epochs=8, contamination=0.05).fit(df)
    s = m.transform(df)
    assert s.where("id < 3").agg(F.min("is_anomaly")).first()[0] == 1
    m.save(scratch + "/ae")
    m2 = AutoencoderModel.load(spark, scratch + "/ae")
    assert np.allclose(m.weights, m2.weights) and m2.threshold == m.threshold


def test_models_do_not_hang_on_partitioning(spark):
    from netsift.operators.detectors import Autoencoder, OneClassSVM
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": np.arange(400), "features": [list(map(float, r)) for r in rng.normal(size=(400, 4))]})
    df = spark.createDataFrame(pdf, "id long, features array<double>")
    for d in (IsolationForest(n_trees=20), Autoencoder(epochs=3), OneClassSVM(rounds=3)):
        a, b = ({r.id: r.anomaly_score for r in d.fit(x).transform(x).collect()} for x in (df.coalesce(1), df.repartition(5, "id")))
        assert max(abs(a[i] - b[i]) for i in a) < 1e-9, type(d).__name__


def test_fit_transform_flags_as_fit_then_transform(spark):
    df, _ = _blob(spark, n=200, d=3, outliers=3, seed=8)
    for d in (IsolationForest(n_trees=20), Autoencoder(epochs=2), OneClassSVM(rounds=2)):
        m, s = d.fit_transform(df)
        again = d.fit(df)
        a, b = ({r.id: (round(r.anomaly_score, 9), r.is_anomaly) for r in x.collect()} for x in (s, again.transform(df)))
        assert a == b and abs(m.threshold - again.threshold) < 1e-9, type(d).__name__


def test_rounds_of_the_svm_read_rows_not_their_features(spark, monkeypatch):
    """The packed shards are as wide as the rows; mapped in the rounds they give what mapped shards gave."""
    from netsift.operators.detectors import ocsvm, training
    x = spark.range(400).select(F.array(F.randn(1), F.randn(2), F.lit(0.5)).alias("features"))
    x = x.unionByName(x.limit(30)).localCheckpoint()
    packed, real = [], ocsvm.run_round
    monkeypatch.setattr(ocsvm, "run_round", lambda data, *a, **k: packed.append(data) or real(data, *a, **k))
    m = OneClassSVM(nu=0.1, n_components=40, rounds=3).fit(x)
    assert {r.d for r in packed[0].select("d").collect()} == {3}
    W, b = m.W, m.b
    to = lambda z: np.sqrt(2.0 / 40) * np.cos(z @ W + b)
    rows = training.shards(x.select(F.col("features").alias("x")), 0.2, 7)
    step = lambda w, z, r: w + z.sum(axis=0)
    loss = lambda w, z: z @ w
    late = training.run_round(training.pack(rows), np.ones(40), step, loss, 0, to)
    early = training.run_round(training.pack(rows, to), np.ones(40), step, loss, 0)
    assert np.array_equal(late[0], early[0]) and late[1:] == early[1:] and 0 < late[2] < 430


def test_rounds_read_held_shards_in_small_batches(spark, monkeypatch):
    """The rounds read shards that executors hold, in batches of a shard or two, and free them; a task returns one vector."""
    from netsift.operators.detectors import autoencoder, training
    seen, real = [], autoencoder.run_round
    monkeypatch.setattr(autoencoder, "run_round", lambda data, *a, **k: seen.append((data, data.storageLevel.useMemory)) or real(data, *a, **k))
    df, _ = _blob(spark, n=300, d=4, outliers=3, seed=9)
    Autoencoder(epochs=2).fit(df)
    assert len(seen) == 3 and all(kept for _, kept in seen) and not seen[0][0].storageLevel.useMemory
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == training.BATCH_BYTES == "4m"
    monkeypatch.setattr(training, "SHARD_ROWS", 50)
    packed = training.pack(training.shards(df.select(F.col("features").alias("x")), 0.2, 7)).coalesce(1)
    assert packed.count() == 6
    for r in packed.collect():
        val = np.frombuffer(r.is_val, bool)
        assert (np.sort(val) == val).all()
    vectors, summed = [], training.array_to_vector
    monkeypatch.setattr(training, "array_to_vector", lambda c: vectors.append(c) or summed(F.transform(c, lambda v: F.lit(1.0))))
    ones, _, n = training.run_round(packed, np.zeros(3), lambda w, z, r: w + len(z), lambda w, z: np.ones(len(z)), 0)
    assert vectors and np.allclose(ones * n, 1.0)  # one vector of ones in all


def test_a_local_epoch_is_plain_adam_on_shuffled_batches():
    from netsift.operators.detectors import autoencoder as ae
    sizes, batch, p, k = ae.layer_sizes(5), 32, 0.2, 3
    X = np.random.default_rng(1).normal(size=(100, 5))
    w = ae.init_weights(sizes, 4)
    state = np.concatenate([w, np.full(len(w), 1e-3), np.full(len(w), 1e-4)])
    given = state.copy()
    got = ae.local_epoch_fn(sizes, batch, p, 7)(state, X, k)
    assert np.array_equal(state, given)
    rng, t = np.random.default_rng([7, k, len(X)]), k * 4
    w, m, v = np.split(given, 3)
    order = rng.permutation(len(X))
    for s in range(0, len(X), batch):
        xb, t = X[order[s:s + batch]], t + 1
        acts, masks = ae.forward(w, sizes, xb, rng, p)
        delta, grad = 2.0 * (acts[-1] - xb) / xb.size, []
        for li in range(len(sizes) - 2, -1, -1):
            grad = [(acts[li].T @ delta).ravel(), delta.sum(axis=0), *grad]
            if li > 0:
                delta = delta @ ae.unpack(w, sizes)[li][0].T * (acts[li] > 0)
                delta = delta if masks[li - 1] is None else delta * masks[li - 1]
        g = np.concatenate(grad)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 1e-3 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-7)
    assert np.allclose(got, np.concatenate([w, m, v]), rtol=1e-12, atol=1e-15)
