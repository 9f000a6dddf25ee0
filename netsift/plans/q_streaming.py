"""Registered streaming queries: the ``events`` table read as a stream until it is used up, its log
rendered and parsed as in the batch queries; results are held against the batch oracle."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.detectors import IsolationForest
from ..operators.joins import materialize
from ..schema import CLOSE_EVENT
from ..session import shared_path
from ..sources.fixtures import flows, render_lines
from ..sources.syslog import parse_lines
from ..streaming import closed_stream, closed_windows_stream, counts_stream, pair_stream, parse_stream, run_available, score_batches
from . import catalog as C
from .registry import r6, register


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed log events of the ``events`` table as a stream."""
    path = os.path.join(sf, "[e]vents.parquet")  # a pattern: the source takes a plain path for a folder
    src = spark.readStream.schema(C.table(spark, sf, "events").schema).parquet(path)
    return parse_lines(render_lines(flows(src)).select("value"))


def _result(spark: SparkSession, df: DataFrame, mode: str) -> DataFrame:
    """Run a stream over all its input into a table in the shared folder and read that."""
    base = shared_path(spark, f"stream-{uuid.uuid4().hex}")
    out = f"{base}/out"

    def handle(batch: DataFrame, batch_id: int) -> None:
        if mode == "complete":
            batch.write.mode("overwrite").parquet(out)
        else:
            batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    run_available(df, f"{base}/checkpoint", handle, mode)
    return spark.read.schema(df.schema).parquet(out)


@register("stream_hour_counts", """
SELECT date_trunc('hour', ts_close) AS window_start, count(*) AS sessions, sum(bytes_sent)::BIGINT AS bytes_sent,
       sum(bytes_rcvd)::BIGINT AS bytes_rcvd FROM closed GROUP BY 1""")
def q_stream_hour_counts(spark, sf):
    """Closed sessions and bytes per hour, by a streaming aggregation."""
    closed = closed_stream(_events_stream(spark, sf), C.FIXTURE_YEAR)
    got = _result(spark, counts_stream(closed, window="1 hour"), "complete")
    return got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("stream_pairs", """
SELECT session_id, src_ip, dst_ip, dst_port, bytes_sent, round(dur_s::DOUBLE, 6) AS duration FROM closed WHERE has_create = 1""")
def q_stream_pairs(spark, sf):
    """Sessions with a CREATE, paired by the stream-stream join."""
    got = _result(spark, pair_stream(_events_stream(spark, sf), C.FIXTURE_YEAR), "append")
    return got.filter(F.col("duration").isNotNull()).select("session_id", "src_ip", "dst_ip", "dst_port", "bytes_sent", r6("duration"))


# Two ordered batches of one log: each is written as files of its own and read from the same checkpoint.
# A tenth of the first half's events come late, in the second batch; another tenth come again in it.
CUT = "2024-01-16 00:00:00"


class _Replay:
    """A log folder that grows batch by batch, and a streaming query run over it after each."""

    def __init__(self, spark: SparkSession, build, mode: str = "append"):
        self.spark, self.mode, self.n = spark, mode, 0
        self.base = shared_path(spark, f"stream-{uuid.uuid4().hex}")
        self.build, self.dropped = build, {"late": 0, "repeated": 0}

    def add(self, lines: DataFrame) -> None:
        lines.select("value").write.text(f"{self.base}/in/batch{self.n}")
        df = self.build(parse_stream(self.spark, f"{self.base}/in/*"))
        self.schema = df.schema

        def handle(batch: DataFrame, batch_id: int) -> None:
            batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.base}/out")

        got = run_available(df, f"{self.base}/checkpoint", handle, self.mode)
        self.dropped = {k: self.dropped[k] + got[k] for k in got}
        self.n += 1

    def result(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.base}/out").select(*self.schema.names)


def _late_replay(spark: SparkSession, sf: str) -> _Replay:
    lines = C.log_lines(spark, sf)
    k = F.pmod(F.col("ord.sid"), F.lit(10))
    early = F.col("ord.t") < F.lit(CUT).cast("timestamp_ntz")
    run = _Replay(spark, lambda ev: closed_windows_stream(closed_stream(ev, C.FIXTURE_YEAR, "1 day")))
    run.add(lines.where(early & (k != 3)))
    run.add(lines.where(~early | k.isin(3, 4)))
    return run


# events are late when older than the first batch's last CLOSE less a day; windows are closed
# when they end before the last CLOSE of all less a day
LATE_CTE = f"""
, c AS (SELECT *, CAST(session_id AS BIGINT) % 10 AS k, ts_close < TIMESTAMP '{CUT}' AS early FROM closed),
w1 AS (SELECT max(ts_close) - INTERVAL 1 DAY AS t FROM c WHERE early AND k <> 3),
w2 AS (SELECT max(ts_close) - INTERVAL 1 DAY AS t FROM c),
again AS (SELECT * FROM c WHERE early AND k = 4),
counted AS (SELECT c.* FROM c, w1 WHERE NOT (early AND k = 3 AND ts_close <= coalesce(t, TIMESTAMP '1970-01-01')))"""


@register("stream_late_windows", LATE_CTE + """
SELECT date_trunc('hour', ts_close) AS window_start, count(*) AS sessions, sum(bytes_sent)::BIGINT AS bytes_sent,
       sum(bytes_rcvd)::BIGINT AS bytes_rcvd FROM counted, w2
WHERE date_trunc('hour', ts_close) + INTERVAL 1 HOUR <= t GROUP BY 1""")
def q_stream_late_windows(spark, sf):
    """Hour windows closed by the watermark over two batches with late and repeated events."""
    return _late_replay(spark, sf).result().withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("stream_late_counts", LATE_CTE + """
SELECT (SELECT count(*) FROM c, w1 WHERE early AND k IN (3, 4) AND ts_close <= t)::BIGINT AS n_late,
       (SELECT count(*) FROM again, w1 WHERE ts_close > t)::BIGINT AS n_repeated""")
def q_stream_late_counts(spark, sf):
    """CLOSE events dropped as late and as repeated over the two batches."""
    d = _late_replay(spark, sf).dropped
    return spark.createDataFrame([(d["late"], d["repeated"])], "n_late long, n_repeated long")


def _pair_replay(spark: SparkSession, sf: str) -> _Replay:
    """CREATE events of every third session arrive in the batch after their CLOSE."""
    lines = C.log_lines(spark, sf)
    late = (F.pmod(F.col("ord.sid"), F.lit(3)) == 0) & (F.col("ord.kind") == 0)
    run = _Replay(spark, lambda ev: pair_stream(ev, C.FIXTURE_YEAR, watermark="40 days", default_duration=-1.0))
    run.add(lines.where(~late))
    run.add(lines.where(late))
    return run


@register("stream_late_creates", """
SELECT session_id, src_ip, dst_port, round(dur_s::DOUBLE, 6) AS duration FROM closed WHERE has_create = 1""")
def q_stream_late_creates(spark, sf):
    """A CLOSE waits in state for a CREATE of a later batch."""
    return _pair_replay(spark, sf).result().select("session_id", "src_ip", "dst_port", r6("duration"))


@register("stream_pair_timeouts", """
, ev AS (SELECT ts_create + to_seconds(dur_s) AS t, close_event AS kind, dst_port, protocol_num FROM flows
         UNION ALL SELECT ts_create, 'CREATE', dst_port, protocol_num FROM flows WHERE has_create = 1),
w AS (SELECT max(t) - INTERVAL 1 HOUR AS t FROM ev WHERE dst_port <> 53 AND protocol_num <> 1)
SELECT session_id, src_ip, dst_port, -1.0::DOUBLE AS duration FROM closed, w
WHERE has_create = 0 AND ts_close + INTERVAL 10 MINUTE < t""")
def q_stream_pair_timeouts(spark, sf):
    """CLOSE events whose CREATE never came take the default once the watermark has passed."""
    got = _result(spark, pair_stream(_events_stream(spark, sf), C.FIXTURE_YEAR, default_duration=-1.0), "append")
    return got.where(F.col("duration") == -1.0).select("session_id", "src_ip", "dst_port", r6("duration"))


@register("stream_scored_alerts", """
SELECT 0::BIGINT AS n_missing, 0::BIGINT AS n_extra, 0::BIGINT AS n_twice, (count(*) > 0)::INTEGER AS has_alerts FROM closed""")
def q_stream_scored_alerts(spark, sf):
    """Alerts of a stream that stops, starts again from its checkpoint with more input, and replays its
    batches, against one batch scoring with the same model."""
    measures = ["bytes_sent", "bytes_rcvd", "pkts_sent", "pkts_rcvd"]

    def featurize(df: DataFrame) -> DataFrame:
        return df.select("session_id", F.array(*(F.log1p(F.col(c).cast("double")) for c in measures)).alias("features"))

    closed = materialize(featurize(C.filtered_events(spark, sf).where(F.col("event_type") == CLOSE_EVENT)))
    model = IsolationForest(n_trees=50, contamination=0.05).fit(closed)
    base = shared_path(spark, f"stream-{uuid.uuid4().hex}")
    lines = C.log_lines(spark, sf)
    first = F.col("ord.t") < F.lit(CUT).cast("timestamp_ntz")
    handle = score_batches(featurize, model, f"{base}/alerts", ["session_id", "anomaly_score"])

    def twice(batch: DataFrame, batch_id: int) -> None:  # a replayed batch writes its own partition again
        handle(batch, batch_id)
        handle(batch, batch_id)

    spark.createDataFrame([], "session_id string, anomaly_score double, batch_id int").write.partitionBy("batch_id").parquet(f"{base}/alerts")
    for k, part in enumerate((lines.where(first), lines.where(~first))):
        part.select("value").write.text(f"{base}/in/batch{k}")
        run_available(closed_stream(parse_stream(spark, f"{base}/in/*"), C.FIXTURE_YEAR), f"{base}/checkpoint", twice)
    got = (spark.read.schema("session_id string, anomaly_score double, batch_id int").parquet(f"{base}/alerts")
           .groupBy(F.col("session_id").alias("k")).agg(F.count(F.lit(1)).alias("n")))
    want = model.transform(closed).where("is_anomaly = 1").select("session_id")
    both = want.join(got, F.col("session_id") == F.col("k"), "full")
    return both.agg(F.count_if(F.col("k").isNull()).alias("n_missing"), F.count_if(F.col("session_id").isNull()).alias("n_extra"),
                    F.count_if(F.col("n") > 1).alias("n_twice"), (F.count("k") > 0).cast("int").alias("has_alerts"))
