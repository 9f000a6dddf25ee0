"""Table catalog: driver tables and the stages derived from them.

Every stage is a DataFrame over the parquet tables in ``sf_dir``; no rows reach the driver.
Stages that several passes read (pairing, feature lookups) are checkpointed as they are
built. The firewall log of the fixtures is rendered from ``events``, so all work
grows with the input tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import any_timestamp
from ..operators.features import engineer_features
from ..operators.sessions import drop_zero_duration, pair_sessions, prepare_events
from ..schema import CREATE_EVENT
from ..session import pin_sql_conf
from ..sources.fixtures import flows, render_lines
from ..sources.syslog import parse_lines

# Calendar year of the fixture log (the events table covers January 2024).
FIXTURE_YEAR = 2024

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_sql_conf(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def flows_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows(table(spark, sf_dir, "events"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RT_FLOW lines rendered from the flows (``value``, ``ord``). A small event becomes up to two long lines, so
    events in fewer splits than the cluster has cores are dealt out first."""
    f, cores = flows_df(spark, sf_dir), spark.sparkContext.defaultParallelism
    return render_lines(f if f.rdd.getNumPartitions() >= cores else f.repartition(cores))


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(log_lines(spark, sf_dir))


def filtered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed events without hostname, DNS and ICMP rows."""
    return prepare_events(parsed_events(spark, sf_dir))


def sessions_df(spark: SparkSession, sf_dir: str, drop_zero: bool = True) -> DataFrame:
    """Closed sessions with duration; zero-duration sessions removed."""
    s = pair_sessions(filtered_events(spark, sf_dir), FIXTURE_YEAR)
    return drop_zero_duration(s) if drop_zero else s


def features_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engineer_features(sessions_df(spark, sf_dir), FIXTURE_YEAR)


def timed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions with typed time and calendar columns: all that profiles and threat
    rules read, without the feature lookups."""
    s = sessions_df(spark, sf_dir)
    return (s.withColumn("timestamp", any_timestamp(F.col("timestamp"), FIXTURE_YEAR).cast("timestamp_ntz"))
            .withColumn("hour", F.hour("timestamp")).withColumn("day_of_week", F.weekday("timestamp"))
            .withColumn("bytes_total", F.col("bytes_sent") + F.col("bytes_rcvd"))
            .withColumn("pkts_total", F.col("pkts_sent") + F.col("pkts_rcvd")))


def ended_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLOSE and DENY events with typed time: one row per attempt, blocked ones included."""
    e = filtered_events(spark, sf_dir).where(F.col("event_type") != CREATE_EVENT)
    return e.withColumn("timestamp", any_timestamp(F.col("timestamp"), FIXTURE_YEAR).cast("timestamp_ntz"))
