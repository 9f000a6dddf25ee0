"""Registered round trips: CSV, written stages, saved models, generic time texts and defaults."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions.timefn import any_timestamp
from ..operators import metrics as M
from ..operators.detectors import IsolationForest, IsolationForestModel
from ..operators.features import engineer_features, fit_scaler
from ..operators.joins import attach_scalars
from ..operators.sessions import drop_zero_duration, pair_sessions, prepare_events
from ..schema import CREATE_EVENT
from ..session import shared_path
from ..sources.fixtures import syslog_time_text
from ..sources.syslog import observed_parse, parse_syslog
from ..sources.files import read_sessions_csv, read_stage, write_csv, write_stage
from . import catalog as C
from .q_analysis import LAB_CTE, labelled
from .q_detectors import _embeddings
from .registry import SESSION_OUT, r6, register

_SESSIONS_SQL = f"SELECT {', '.join(c if c != 'duration' else 'round(duration, 6) AS duration' for c in SESSION_OUT)} FROM sessions"


@register("csv_roundtrip", _SESSIONS_SQL)
def q_csv_roundtrip(spark, sf):
    """Closed sessions written as CSV and read again with the declared schema."""
    path = shared_path(spark, f"csv-{uuid.uuid4().hex}")
    write_csv(C.sessions_df(spark, sf).select(*SESSION_OUT), path)
    return read_sessions_csv(spark, path).select(*[c if c != "duration" else r6("duration") for c in SESSION_OUT])


@register("stage_roundtrip", _SESSIONS_SQL)
def q_stage_roundtrip(spark, sf):
    """Closed sessions written as a stage, partitioned by protocol, and read again."""
    name = f"stage-{uuid.uuid4().hex}"
    s = C.sessions_df(spark, sf)
    write_stage(s, name, partition_by=["protocol"])
    return read_stage(spark, name, schema=s.schema).select(*[c if c != "duration" else r6("duration") for c in SESSION_OUT])


@register("model_roundtrip", "SELECT count(*) AS n, 0::BIGINT AS n_changed FROM embeddings")
def q_model_roundtrip(spark, sf):
    """A saved and loaded model scores every row as before."""
    x = _embeddings(spark, sf)
    path = shared_path(spark, f"model-{uuid.uuid4().hex}")
    model = IsolationForest(contamination=0.05).fit(x)
    model.save(path)
    again = IsolationForestModel.load(spark, path).transform(x).select("id", F.col("anomaly_score").alias("s"), F.col("is_anomaly").alias("a"))
    both = model.transform(x).join(again, "id")
    same = (F.col("anomaly_score") == F.col("s")) & (F.col("is_anomaly") == F.col("a"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.sum((~same).cast("long")).alias("n_changed"))


@register("generic_times", """
SELECT session_id, CASE CAST(session_id AS BIGINT) % 3 WHEN 2 THEN -1 ELSE hour(ts_close) END::INTEGER AS hour,
       CASE CAST(session_id AS BIGINT) % 3 WHEN 2 THEN -1 ELSE isodow(ts_close) - 1 END::INTEGER AS day_of_week
FROM closed""")
def q_generic_times(spark, sf):
    """syslog, ISO and unreadable time texts in one column (no time: -1)."""
    from ..functions.timefn import syslog_timestamp
    s = C.sessions_df(spark, sf, drop_zero=False)
    k = F.pmod(F.col("session_id").cast("long"), F.lit(3))
    iso = F.date_format(syslog_timestamp("timestamp", C.FIXTURE_YEAR), "yyyy-MM-dd HH:mm:ss")
    text = F.when(k == 0, F.col("timestamp")).when(k == 1, iso).otherwise(F.lit("not a time"))
    ts = any_timestamp(text, C.FIXTURE_YEAR)
    return s.select("session_id", F.coalesce(F.hour(ts), F.lit(-1)).alias("hour"),
                    F.coalesce(F.weekday(ts), F.lit(-1)).alias("day_of_week"))


@register("time_defaults", "SELECT session_id, 12 AS hour, 0 AS day_of_week, 0 AS is_night FROM sessions")
def q_time_defaults(spark, sf):
    """features of sessions without a time column take the defaults."""
    f = engineer_features(C.sessions_df(spark, sf).drop("timestamp"), C.FIXTURE_YEAR)
    return f.select("session_id", "hour", "day_of_week", F.col("is_night").cast("int").alias("is_night"))


@register("score_density_all", LAB_CTE + """
, x AS (SELECT score AS x FROM lab WHERE score IS NOT NULL),
r0 AS (SELECT min(x) AS mn, max(x) AS mx, count(*) AS tot, quantile_cont(x, 0.95) AS threshold FROM x),
r AS (SELECT tot, threshold, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM r0),
cnt AS (SELECT least(CAST(floor((x - lo) / (hi - lo) * 100) AS INTEGER), 99) AS bin, count(*) AS n FROM x, r GROUP BY 1),
axis AS (SELECT lo, hi, tot, threshold, CAST(unnest(generate_series(0, 99)) AS INTEGER) AS bin FROM r)
SELECT 'all' AS class, axis.bin, round(lo + bin * ((hi - lo) / 100), 6) AS bin_lo, coalesce(n, 0) AS n,
       round(coalesce(n, 0) / (tot * ((hi - lo) / 100)), 6) AS density, round(threshold, 6) AS threshold,
       (round(lo + bin * ((hi - lo) / 100), 6) > round(threshold, 6))::INTEGER AS flagged
FROM axis LEFT JOIN cnt USING (bin)""")
def q_score_density_all(spark, sf):
    """Density of all scores in 100 bins with the 95th percentile."""
    return M.score_density_with_threshold(labelled(spark, sf), "score")


@register("log_files_scan", _SESSIONS_SQL)
def q_log_files_scan(spark, sf):
    """The log as rotated text files, scanned in several splits and paired; every seventh session has a
    second CREATE some seconds later, in another split as a rule, which must not count."""
    lines = C.log_lines(spark, sf)
    second = lines.where((F.col("ord.kind") == 0) & (F.pmod(F.col("ord.sid"), F.lit(7)) == 0))
    at = F.timestamp_add("SECOND", F.lit(7), F.col("ord.t"))
    second = second.select(F.concat(syslog_time_text(at), F.substring("value", 16, 1 << 30)).alias("value"),
                           F.struct(at.alias("t"), F.col("ord.sid").alias("sid"), F.col("ord.kind").alias("kind")).alias("ord"))
    path = shared_path(spark, f"log-{uuid.uuid4().hex}")
    # range partitions become files in the order of the log; a task sorts one of them
    files = max(6, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lines.unionByName(second).repartitionByRange(files, "ord").sortWithinPartitions("ord").select("value").write.text(path)
    s = drop_zero_duration(pair_sessions(prepare_events(parse_syslog(spark, path)), C.FIXTURE_YEAR))
    return s.select(*[c if c != "duration" else r6("duration") for c in SESSION_OUT])


@register("accounting_observed", """
SELECT (SELECT count(*) FROM parsed) AS n_parsed, (SELECT count(*) FROM parsed WHERE event_type = 'RT_FLOW_SESSION_CLOSE') AS n_close_parsed,
       0::BIGINT AS n_no_match, count(*) AS n_close, sum(has_create)::BIGINT AS n_paired,
       (count(*) - sum(has_create))::BIGINT AS n_median_filled FROM closed""")
def q_accounting_observed(spark, sf):
    """Parse and pairing counts from the one job that writes the events and the one that writes the
    sessions (observed metrics, no second read)."""
    parsed, paired = Observation("parse"), Observation("pair")
    events = observed_parse(C.log_lines(spark, sf), parsed)
    s = pair_sessions(prepare_events(events), C.FIXTURE_YEAR, with_flags=True).observe(
        paired, F.count(F.lit(1)).alias("n_close"), F.count_if("is_paired").alias("n_paired"), F.count_if("median_filled").alias("n_filled"))
    s.write.parquet(shared_path(spark, f"sessions-{uuid.uuid4().hex}"))
    a, b = parsed.get, paired.get
    return spark.createDataFrame([(a["n_parsed"], a["n_RT_FLOW_SESSION_CLOSE"], a["n_no_match"], b["n_close"], b["n_paired"], b["n_filled"])],
                                 "n_parsed long, n_close_parsed long, n_no_match long, n_close long, n_paired long, n_median_filled long")


@register("midnight_fix", """
SELECT session_id, round(CASE WHEN CAST(session_id AS BIGINT) % 5 = 0 AND dur_s > 0 THEN 86400.0 - dur_s ELSE dur_s END, 6) AS duration
FROM closed WHERE has_create = 1""")
def q_midnight_fix(spark, sf):
    """sessions whose CREATE is stamped after their CLOSE get one day, once."""
    e = C.filtered_events(spark, sf)
    swap = F.pmod(F.col("session_id").cast("long"), F.lit(5)) == 0
    ends = C.flows_df(spark, sf).select(F.col("session_id").alias("k"), "ts_create", "dur_s")
    shifted = F.timestamp_add("SECOND", (2 * F.col("dur_s")).cast("int"), F.col("ts_create"))  # as far behind the CLOSE as it was before
    stamp = F.when(swap & (F.col("event_type") == CREATE_EVENT) & (F.col("dur_s") > 0), syslog_time_text(shifted)).otherwise(F.col("timestamp"))
    moved = e.join(ends, F.col("session_id") == F.col("k")).withColumn("timestamp", stamp).drop("k", "ts_create", "dur_s")
    s = pair_sessions(moved, C.FIXTURE_YEAR, with_flags=True).where("is_paired")
    return s.select("session_id", r6("duration"))


@register("matrix_stage", f"SELECT session_id, {', '.join(f'round({c}, 6) AS {c}' for c in ('log_bytes_sent', 'log_duration'))} FROM feat")
def q_matrix_stage(spark, sf):
    """The standardised matrix written as a stage with its vector column, read again and scaled back."""
    f = C.features_df(spark, sf)
    m = fit_scaler(f, ["log_bytes_sent", "log_duration"])
    name = f"matrix-{uuid.uuid4().hex}"
    write_stage(m.transform(f).select("session_id", "features"), name)
    back = f.agg(*(g(c).alias(f"{k}_{c}") for c in ("log_bytes_sent", "log_duration") for k, g in (("m", F.avg), ("s", F.stddev_pop))))
    v = vector_to_array("features")
    cols = [r6(v[i] * F.coalesce(F.nullif(F.col(f"s_{c}"), F.lit(0.0)), F.lit(1.0)) + F.col(f"m_{c}"), c) for i, c in enumerate(("log_bytes_sent", "log_duration"))]
    return attach_scalars(read_stage(spark, name), back).select("session_id", *cols)
