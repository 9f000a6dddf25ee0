"""CREATE/CLOSE pairing: session durations from syslog event pairs.

Plan shape (one shuffle per side, skew-safe):

* CREATE side: ``groupBy(session_id).agg(min_by(ts, ord))`` — the first CREATE per
  session in log order. Partial aggregation collapses a hot session id map-side.
* CLOSE side: left outer equi-join on ``session_id``. The CREATE table is checkpointed, so
  both sides of the join are exchanges of their own: AQE broadcasts a small CREATE table
  and otherwise splits the CLOSE partitions of a hot session id (an aggregate directly
  below the join would keep it from splitting).
* Median of paired durations: ``exact_quantiles`` (range partitions of value counts, no
  task holds all values), attached to every row by a one-row broadcast.
* The log is read and parsed once: CREATE and CLOSE events are written as one parquet stage
  (shared folder); the CREATE table, the median and the output read the columns they need
  from it. The median's pass joins three narrow columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import syslog_timestamp
from .joins import materialize, stage
from .quantiles import exact_quantiles
from ..schema import CLOSE_EVENT, CREATE_EVENT

SECONDS_PER_DAY = 86400.0


def prepare_events(events: DataFrame, drop_dns: bool = True, drop_icmp: bool = True) -> DataFrame:
    """Drop ``hostname``; remove DNS (dst_port 53) and ICMP rows, keeping NULLs (null-safe)."""
    df = events.drop("hostname")
    if drop_dns:
        df = df.where(~F.col("dst_port").eqNullSafe(53))
    if drop_icmp:
        df = df.where(~F.col("protocol").eqNullSafe("ICMP"))
    return df


def pair_sessions(events: DataFrame, year: int, median: str = "exact",
                  with_flags: bool = False) -> DataFrame:
    """CLOSE rows with ``duration`` (seconds, 0.1 s) from the first CREATE of the same session.

    * the first CREATE is the one with the least ``ord`` (place in the log); events without that
      column, such as those of a CSV file, are ordered by their time, unknown times last;
    * negative duration (CREATE after CLOSE in the log) gets +86400 s once;
    * CLOSE without CREATE gets the median of the paired durations (``median`` =
      ``exact`` or ``approx``);
    * helper columns are dropped; with ``with_flags`` the row keeps ``is_paired``,
      ``was_negative`` and ``median_filled`` (for the pairing report).
    """
    ts = syslog_timestamp(F.col("timestamp"), year)
    first = F.col("ord") if "ord" in events.columns else F.struct(ts.isNull().alias("late"), ts.alias("t"))
    keep = [c for c in events.columns if c not in ("ord", "duration")]
    both = stage(events.where(F.col("event_type").isin(CREATE_EVENT, CLOSE_EVENT))
                 .select(*keep, ts.alias("ts_close"), first.alias("_ord")), "events")
    creates = materialize(both.where(F.col("event_type") == CREATE_EVENT).groupBy("session_id")
                          .agg(F.min_by("ts_close", "_ord").alias("ts_create")))
    j = both.where(F.col("event_type") == CLOSE_EVENT).drop("_ord").join(creates, "session_id", "left")
    raw = F.round(F.timestamp_diff("SECOND", F.col("ts_create"), F.col("ts_close")).cast("double"), 1)
    j = j.withColumn("_d0", raw)
    j = j.withColumn("_neg", F.coalesce(F.col("_d0") < 0, F.lit(False)))
    j = j.withColumn("_d1", F.when(F.col("_neg"), F.col("_d0") + SECONDS_PER_DAY).otherwise(F.col("_d0")))
    if median == "exact":
        med = exact_quantiles(j, "_d1", [0.5], prefix="_m").select(F.col("_m0").alias("_median"))
    else:
        med = j.agg(F.percentile_approx("_d1", 0.5, 10000).cast("double").alias("_median"))
    j = j.crossJoin(F.broadcast(med))
    dur = F.coalesce(F.col("_d1"), F.col("_median"))
    out = j.withColumn("duration", dur)
    if with_flags:
        out = (out.withColumn("is_paired", F.col("_d0").isNotNull())
               .withColumn("was_negative", F.col("_neg"))
               .withColumn("median_filled", F.col("_d0").isNull() & F.col("_median").isNotNull()))
    cols = [c for c in keep if c != "session_id"]
    order = [c for c in events.columns if c in cols or c == "session_id"] + ["duration"]
    if with_flags:
        order += ["is_paired", "was_negative", "median_filled"]
    return out.select(*order)


def drop_zero_duration(sessions: DataFrame) -> DataFrame:
    """Remove sessions of duration 0, keeping NULL durations (null-safe ``!=``)."""
    return sessions.where(~F.col("duration").eqNullSafe(0.0))


def pairing_report(events: DataFrame, year: int) -> DataFrame:
    """One row: CLOSE rows, paired, percent paired, fixed negatives, median-filled."""
    s = pair_sessions(events, year, with_flags=True)
    total = F.count(F.lit(1))
    matched = F.count_if(F.col("is_paired"))
    return s.agg(
        total.alias("n_close"),
        matched.alias("n_paired"),
        F.round(F.try_divide(matched * 100.0, total), 6).alias("pct_paired"),
        F.count_if(F.col("was_negative")).alias("n_negative_fixed"),
        F.count_if(F.col("median_filled")).alias("n_median_filled"),
        F.round(F.max(F.when(F.col("median_filled"), F.col("duration"))), 6).alias("median_fill_value"),
    )
