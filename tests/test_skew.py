"""Hot keys: results stay exact when one key holds a large share of the rows."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from netsift.operators.detectors.neighbors import knn
from netsift.operators.features import engineer_features
from netsift.operators.sessions import pair_sessions


def test_hot_source_and_reused_session(spark):
    rng = np.random.default_rng(11)
    n = 900
    src = np.where(np.arange(n) % 3 == 0, "10.0.0.1", [f"10.1.{i % 50}.{i % 200}" for i in range(n)])
    sessions = pd.DataFrame({
        "timestamp": [f"Jan  2 10:{i % 60:02d}:{(i * 7) % 60:02d}" for i in range(n)],
        "src_ip": src, "dst_ip": [f"8.8.{i % 7}.{i % 11}" for i in range(n)],
        "src_port": rng.integers(1025, 60000, n).astype("int32"), "dst_port": rng.choice([443, 80, 22, 9999], n)
        .astype("int32"), "protocol_num": np.full(n, 6, dtype="int32"), "protocol": "TCP", "action": "close",
        "session_id": [str(i) for i in range(n)], "pkts_sent": rng.integers(1, 50, n), "bytes_sent":
        rng.integers(1, 10000, n), "pkts_rcvd": rng.integers(0, 50, n), "bytes_rcvd": rng.integers(0, 10000, n),
        "duration": rng.integers(1, 100, n).astype(float)})
    f = engineer_features(spark.createDataFrame(sessions), 2024)
    got = {r.session_id: r for r in f.select("session_id", "src_connection_count", "src_unique_dst_ports",
                                             "src_unique_dst_ips").collect()}
    g = sessions.groupby("src_ip")
    want_n = g["dst_port"].transform("count")
    want_p = g["dst_port"].transform("nunique")
    want_i = g["dst_ip"].transform("nunique")
    for i in range(n):
        r = got[str(i)]
        assert (r.src_connection_count, r.src_unique_dst_ports, r.src_unique_dst_ips) == \
            (want_n[i], want_p[i], want_i[i])

    # one session id reused by a third of all events: every CLOSE pairs with the first CREATE
    ev = [(f"Jan  1 00:00:{i % 60:02d}", "RT_FLOW_SESSION_CREATE" if i % 2 == 0 else "RT_FLOW_SESSION_CLOSE",
           "42" if i % 3 == 0 else str(i // 2), i) for i in range(600)]
    df = spark.createDataFrame(ev, "timestamp string, event_type string, session_id string, ord int")
    first_create_42 = min(i for i in range(600) if i % 3 == 0 and i % 2 == 0)
    for r in pair_sessions(df, 2024).where("session_id = '42'").collect():
        assert r.duration is not None
    s = pair_sessions(df, 2024).where("session_id = '42'").agg(F.count(F.lit(1))).first()[0]
    assert s == sum(1 for t, e, sid, _ in ev if sid == "42" and e == "RT_FLOW_SESSION_CLOSE")
    assert first_create_42 == 0


def test_knn_with_crowded_cell_and_duplicates(spark):
    rng = np.random.default_rng(5)
    X = np.vstack([np.tile([[0.5, 0.5, 0.5]], (60, 1)), rng.normal(0, 1, (140, 3))])
    pdf = pd.DataFrame({"id": np.arange(len(X)), "x": [list(r) for r in X]})
    df = spark.createDataFrame(pdf, "id long, x array<double>")
    k = 7
    nn = {r.qid: [(e.dist, e.id) for e in r.nbrs] for r in knn(df.withColumnRenamed("id", "qid")
                                                             .withColumnRenamed("qid", "id"), df, k, block=4)
          .collect()}
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    for i in range(len(X)):
        order = np.lexsort((np.arange(len(X)), D[i]))[:k]
        assert [b for _, b in nn[i]] == list(order)
        assert np.allclose([a for a, _ in nn[i]], D[i, order])


def test_pairing_join_splits_a_hot_session(spark):
    """With a session id that holds two thirds of the CLOSE rows, the join's partition is split."""
    from pyspark.sql import functions as F

    from netsift.operators.sessions import pair_sessions
    from netsift.schema import CLOSE_EVENT, CREATE_EVENT
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = spark.range(30000).repartition(8)
        sid = F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        text = F.concat(F.lit("Jan 12 10:00:"), F.lpad((F.col("id") % 60).cast("string"), 2, "0"))
        closes = n.select(sid.alias("session_id"), text.alias("timestamp"), F.lit(CLOSE_EVENT).alias("event_type"),
                          F.md5(F.col("id").cast("string")).alias("pad"), F.col("id").alias("ord"), F.lit(0.0).alias("duration"))
        events = closes.unionByName(closes.withColumn("event_type", F.lit(CREATE_EVENT)).withColumn("ord", -F.col("ord")))
        out = pair_sessions(events, 2024, median="approx")
        assert out.count() == 30000
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_equal_rows_are_spread_over_training_shards(spark):
    """A vector that holds most rows is dealt in lots, not to one shard."""
    from netsift.operators.detectors.training import LOT, SHARD_ROWS, shards
    hot = spark.range(4 * SHARD_ROWS).select(F.array(F.lit(1.0), F.lit(2.0)).alias("x"))
    rest = spark.range(100).select(F.array(F.rand(1), F.rand(2)).alias("x"))
    dealt = shards(hot.unionByName(rest), 0.1, 3)
    per = {r.shard: r.n for r in dealt.groupBy("shard").agg(F.sum("m").alias("n")).collect()}
    assert sum(per.values()) == 4 * SHARD_ROWS + 100
    assert len(per) > 1 and max(per.values()) < 4 * SHARD_ROWS
    assert dealt.agg(F.max("m")).first()[0] <= LOT
    assert 0 < dealt.where("is_val").agg(F.sum("m")).first()[0] < 4 * SHARD_ROWS


def test_equal_rows_do_not_meet_in_one_tree(spark):
    """Equal vectors are drawn by their count: a tree of a hot vector stays within its sample size."""
    from netsift.operators.detectors import IsolationForest
    from netsift.operators.detectors.iforest import _copies
    hot = spark.range(30_000).select(F.array(F.lit(0.0), F.lit(0.0)).alias("features"))
    rest = spark.range(3_000).select(F.array(F.randn(1), F.randn(2)).alias("features"))
    m = IsolationForest(n_trees=20, max_samples=64).fit(hot.unionByName(rest))
    roots = m.forest[m.forest["node"] == 0]
    assert len(roots) == 20 and (roots["size"] == 64).all()
    s = m.transform(spark.createDataFrame([([0.0, 0.0],), ([9.0, 9.0],)], "features array<double>"))
    low, high = (r.anomaly_score for r in s.collect())
    assert high > low
    # about n * p copies, given one at least
    assert _copies(1, 0.1, 0.3) == 1 and _copies(10_000, 0.01, 0.5) in range(95, 105) and _copies(50, 1.0, 0.2) == 50


def test_time_axis_is_made_in_runs(spark):
    from netsift.operators.profile import traffic_timeline
    rows = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:30' AS timestamp UNION ALL "
                     "SELECT timestamp_ntz'2024-01-04 05:06:07'")
    got = traffic_timeline(rows, "minute").orderBy("bin").collect()
    assert len(got) == 3 * 1440 + 5 * 60 + 7 and [got[0].sessions, got[1].sessions, got[-1].sessions] == [1, 0, 1]
    assert traffic_timeline(rows.limit(0), "minute").count() == 0


def test_training_shards_are_dealt_evenly(spark, monkeypatch):
    """Partitions hold as many shards as one another, or one more; every row is in one shard."""
    from netsift.operators.detectors import training
    monkeypatch.setattr(training, "SHARD_ROWS", 50)
    x = spark.range(2_000).select(F.array(F.col("id").cast("double")).alias("x"))
    dealt = training.shards(x, 0.1, 3).withColumn("p", F.spark_partition_id())
    assert dealt.agg(F.sum("m")).first()[0] == 2_000
    per = [r.n for r in dealt.groupBy("p").agg(F.countDistinct("shard").alias("n")).collect()]
    assert len(per) == 4 and max(per) - min(per) <= 1
    assert dealt.groupBy("shard").agg(F.countDistinct("p").alias("n")).where("n > 1").isEmpty()
