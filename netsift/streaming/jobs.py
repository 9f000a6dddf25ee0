"""Streaming jobs.

* ``parse_stream`` — ``readStream.text`` + the batch parser (stateless projection).
* ``pair_stream`` — pairing by a two-sided stream-stream outer join, all in the JVM on RocksDB
  state: CREATE events keep the first arrival of a session (deduplication within the
  watermark), CLOSE events wait for a CREATE within a time range. See its docstring.
* ``closed_stream`` — CLOSE events with their time, without pairing (for counts).
* ``counts_stream`` — sessions / bytes per tumbling window with a watermark (append).
* ``closed_windows_stream`` — the same without repeated events; late rows are dropped, and
  ``run_available`` counts them.
* ``port_scan_stream`` — distinct destination ports per source in sliding windows, from one
  mergeable sketch per pane (bounded state, no row copied per window).
* ``score_batches`` — ``foreachBatch``: features on the micro-batch, a fitted model's
  ``transform``; a batch id's alerts replace that batch id's partition (idempotent).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import syslog_timestamp
from ..operators.sessions import SECONDS_PER_DAY, prepare_events
from ..schema import CLOSE_EVENT, CREATE_EVENT
from ..sources.syslog import parse_lines


def parse_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_lines(r.load(path).select("value"))


def _timed(events: DataFrame, year: int, drop_dns: bool, drop_icmp: bool) -> DataFrame:
    return prepare_events(events, drop_dns, drop_icmp).withColumn(
        "ts", syslog_timestamp("timestamp", year).cast("timestamp"))


def closed_stream(events: DataFrame, year: int, watermark: str = "10 minutes", drop_dns: bool = True,
                  drop_icmp: bool = True) -> DataFrame:
    """CLOSE events with ``ts_close`` under a watermark."""
    ev = _timed(events, year, drop_dns, drop_icmp).where(F.col("event_type") == CLOSE_EVENT)
    return ev.withColumnRenamed("ts", "ts_close").withWatermark("ts_close", watermark)


def pair_stream(events: DataFrame, year: int, watermark: str = "10 minutes", max_session: str = "1 hour",
                max_ahead: str = "10 minutes", default_duration: float | None = None, drop_dns: bool = True,
                drop_icmp: bool = True) -> DataFrame:
    """Streaming CREATE/CLOSE pairing → closed sessions with ``duration`` and ``ts_close``.

    A CLOSE is joined with the CREATE of its session that lies up to ``max_session`` before it, or up
    to ``max_ahead`` after it (a negative duration gets one day, as in the batch rule), whichever
    of the two arrives first. A session's CREATE is the first to arrive; of several in one
    micro-batch, the first that the state operator reads (the order of the log within an input split).
    The batch rule takes the first of the whole log, so the two agree unless a session id comes
    back after its state has expired. A CLOSE without a CREATE comes out with ``default_duration``
    once the watermark has passed all CREATE events it could join (a global median is not
    defined on an unbounded stream).

    The event-time delay is the longer of ``watermark`` and ``max_session``, so that a repeated CREATE
    is still known as such while its session can be joined. Both sides read the source, and
    the watermark of each sees all its events.
    """
    ev = _timed(events, year, drop_dns, drop_icmp)
    delay = max(watermark, max_session, key=pd.Timedelta)
    ev = ev.where(F.col("ts").isNotNull() & F.col("session_id").isNotNull()).withWatermark("ts", delay)

    def side(kind: str) -> DataFrame:
        # a condition on ``ts`` stays above the watermark, which so advances with events of either kind
        return ev.where(F.when(F.col("event_type") == kind, F.col("ts")).isNotNull())

    creates = (side(CREATE_EVENT).dropDuplicatesWithinWatermark(["session_id"])
               .select(F.col("session_id").alias("created_id"), F.col("ts").alias("ts_create")))
    keep = [c for c in ev.columns if c not in ("duration", "ts", "ord")]
    closes = side(CLOSE_EVENT).select(*keep, F.col("ts").alias("ts_close"))
    near = (F.col("ts_create") >= F.col("ts_close") - F.expr(f"interval {max_session}")) \
        & (F.col("ts_create") <= F.col("ts_close") + F.expr(f"interval {max_ahead}"))
    paired = closes.join(creates, (F.col("session_id") == F.col("created_id")) & near, "leftOuter")
    d = F.round((F.unix_micros("ts_close") - F.unix_micros("ts_create")) / 1e6, 1)
    return paired.select(*keep, F.coalesce(F.when(d < 0, d + SECONDS_PER_DAY).otherwise(d), F.lit(default_duration).cast("double"))
                         .alias("duration"), "ts_close")


def counts_stream(sessions: DataFrame, ts: str = "ts_close", window: str = "1 minute",
                  watermark: str | None = None) -> DataFrame:
    """``watermark`` only for a source without one."""
    src = sessions.withWatermark(ts, watermark) if watermark else sessions
    return (src
            .groupBy(F.window(ts, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("sessions"), F.sum("bytes_sent").alias("bytes_sent"),
                 F.sum("bytes_rcvd").alias("bytes_rcvd"))
            .select(F.col("w.start").alias("window_start"), "sessions", "bytes_sent", "bytes_rcvd"))


def closed_windows_stream(sessions: DataFrame, ts: str = "ts_close", window: str = "1 hour", key: str = "session_id") -> DataFrame:
    """Sessions and bytes per closed window (append mode) of a source under a watermark: an event that
    comes again within the watermark counts once, one older than the watermark is dropped."""
    return counts_stream(sessions.dropDuplicatesWithinWatermark([key]), ts, window)


def port_scan_stream(sessions: DataFrame, ts: str = "ts_close", window: str = "10 minutes",
                     slide: str = "5 minutes", min_ports: int = 20, watermark: str | None = None) -> DataFrame:
    """Sources with many distinct destination ports per sliding window: a sketch per (source, pane)
    is the first aggregation, and windows unite the sketches of their panes."""
    src = sessions.withWatermark(ts, watermark) if watermark else sessions
    panes = (src.groupBy(F.window(ts, slide).alias("pane"), "src_ip")
             .agg(F.hll_sketch_agg(F.col("dst_port").cast("long")).alias("ports"), F.count(F.lit(1)).alias("n")))
    g = (panes.groupBy(F.window(F.window_time("pane"), window, slide).alias("w"), "src_ip")
         .agg(F.hll_sketch_estimate(F.hll_union_agg("ports")).alias("distinct_ports"), F.sum("n").alias("connections")))
    return g.where(F.col("distinct_ports") >= min_ports).select(
        F.col("w.start").alias("window_start"), "src_ip", "distinct_ports", "connections")


def score_batches(featurize: Callable[[DataFrame], DataFrame], model, alert_path: str,
                  columns: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: featurize the micro-batch, score it, append anomalies as
    parquet under ``alert_path`` with the batch id (idempotent per batch id)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        scored = model.transform(featurize(batch))
        alerts = scored.where(F.col("is_anomaly") == 1)
        if columns:
            alerts = alerts.select(*[c for c in columns if c in alerts.columns])
        # a replayed batch id overwrites its own partition and no other
        alerts.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(alert_path)

    return handle


def _rocksdb(spark: SparkSession) -> None:
    """State on local disk with changelogs in the checkpoint folder, not in the executors' heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "10000")


def run_available(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append") -> dict[str, int]:
    """Process what the source holds now, batch by batch, with ``handle``; then stop.

    Returns the rows that were dropped as late (older than the watermark) and as repeated."""
    _rocksdb(df.sparkSession)
    q = (df.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    ops = [op for p in q.recentProgress for op in p.stateOperators]
    return {"late": sum(op.numRowsDroppedByWatermark for op in ops),
            "repeated": sum(int(op.customMetrics.get("numDroppedDuplicateRows", 0)) for op in ops)}


def start_memory_query(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None):
    """Start a query into the in-memory sink (tests / notebooks)."""
    _rocksdb(df.sparkSession)
    w = df.writeStream.format("memory").queryName(name).outputMode(mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()
