"""Registered queries: name → (Spark builder, DuckDB oracle SQL or None).

Spark builders take ``(spark, sf_dir)`` and return a DataFrame (stages that several
passes read are checkpointed as they are built). Column names
and types line up with the oracle SQL; doubles are rounded to 6 decimals on both
sides so the value hashes compare engines, not last-bit float noise.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LOG_COLUMNS, PARSED_NAMES
from ..sources.syslog import parse_accounting
from . import catalog as C
from . import oracle_sql as O


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, note: str = ""):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, None if sql is None else O.base_with() + sql, note)
        return fn
    return deco


def r6(c, alias: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col.cast("double"), 6)
    return out.alias(alias or (c if isinstance(c, str) else "value"))


# ---------------------------------------------------------------------------
# Parsing
# ---------------------------------------------------------------------------

EVENT_OUT = PARSED_NAMES + ["protocol", "action", "duration"]


@register("parse_roundtrip", f"SELECT {', '.join(EVENT_OUT)} FROM parsed")
def q_parse_roundtrip(spark, sf):
    """Every rendered line parsed back into its 24 fields + protocol/action."""
    return C.parsed_events(spark, sf).select(*EVENT_OUT)


@register("parse_accounting", """
SELECT 'status' AS dimension, 'parsed' AS value, count(*) AS n FROM parsed
UNION ALL SELECT 'event_type', event_type, count(*) FROM parsed GROUP BY event_type
UNION ALL SELECT 'protocol', protocol, count(*) FROM parsed GROUP BY protocol""")
def q_parse_accounting(spark, sf):
    """Rows per parse status, per event type, per protocol."""
    return parse_accounting(C.log_lines(spark, sf))


# ---------------------------------------------------------------------------
# Pairing
# ---------------------------------------------------------------------------

SESSION_OUT = [c for c in EVENT_OUT if c != "hostname"]


@register("session_durations", f"SELECT {', '.join(c if c != 'duration' else 'round(duration, 6) AS duration' for c in SESSION_OUT)} FROM sessions")
def q_session_durations(spark, sf):
    """Closed sessions with duration (non-zero)."""
    s = C.sessions_df(spark, sf)
    return s.select(*[c if c != "duration" else r6("duration") for c in SESSION_OUT])


@register("pairing_report", """
SELECT count(*) AS n_close, count(*) FILTER (WHERE has_create = 1) AS n_paired,
       round(count(*) FILTER (WHERE has_create = 1) * 100.0 / count(*), 6) AS pct_paired,
       CAST(0 AS BIGINT) AS n_negative_fixed,
       count(*) FILTER (WHERE has_create = 0) AS n_median_filled,
       round(max(CASE WHEN has_create = 0 THEN duration END), 6) AS median_fill_value
FROM sessions_all""")
def q_pairing_report(spark, sf):
    """Matched / total CLOSE rows, negatives fixed, median-filled rows."""
    from ..operators.sessions import pairing_report
    return pairing_report(C.filtered_events(spark, sf), C.FIXTURE_YEAR)


# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------

NET = ["bytes_ratio", "pkts_ratio", "bytes_per_sec", "pkts_per_sec", "avg_pkt_size"]


@register("features_network", "SELECT session_id, bytes_total, pkts_total, "
          + ", ".join(O.r6(c, c) for c in NET) + " FROM feat")
def q_features_network(spark, sf):
    """Totals, ratios, rates, mean packet size."""
    return C.features_df(spark, sf).select("session_id", "bytes_total", "pkts_total", *[r6(c) for c in NET])


PORTS = ["dst_port", "is_well_known_port", "is_high_port", "is_privileged_port", "is_rare_dst_port"]


@register("features_ports", f"SELECT session_id, {', '.join(PORTS)} FROM feat")
def q_features_ports(spark, sf):
    """F6, F7, A5 + J3/J4: port flags and the rare-port flag."""
    return C.features_df(spark, sf).select("session_id", *PORTS)


IPS = ["src_is_private", "dst_is_private", "is_outbound", "is_inbound", "is_internal"]


@register("features_ip", f"SELECT session_id, src_ip, dst_ip, {', '.join(IPS)} FROM feat")
def q_features_ip(spark, sf):
    """F1, F2, F8: RFC 1918 flags and direction."""
    return C.features_df(spark, sf).select("session_id", "src_ip", "dst_ip", *IPS)


BEH = ["src_connection_count", "src_unique_dst_ports", "src_unique_dst_ips"]


@register("features_behaviour", f"SELECT session_id, src_ip, {', '.join(BEH)} FROM feat")
def q_features_behaviour(spark, sf):
    """Per-source connection count and distinct ports / destinations."""
    return C.features_df(spark, sf).select("session_id", "src_ip", *BEH)


@register("features_time", "SELECT session_id, ts AS timestamp, hour, day_of_week, is_night, protocol_enc, is_denied "
          "FROM feat")
def q_features_time(spark, sf):
    """Time of day, weekday, night flag, protocol code, deny flag."""
    return C.features_df(spark, sf).select("session_id", "timestamp", "hour", "day_of_week", "is_night",
                                           "protocol_enc", "is_denied")


LOGS = [f"log_{c}" for c in LOG_COLUMNS]


@register("features_log", "SELECT session_id, " + ", ".join(O.r6(c, c) for c in LOGS) + " FROM feat")
def q_features_log(spark, sf):
    """F16: log1p of the eight traffic measures."""
    return C.features_df(spark, sf).select("session_id", *[r6(c) for c in LOGS])


def _matrix_sql() -> str:
    from ..schema import FEATURE_COLUMNS
    cols = []
    for c in FEATURE_COLUMNS:
        x = f"coalesce(CAST({c} AS DOUBLE), 0)"
        cols.append(f"round(coalesce(({x} - avg({x}) OVER ()) / nullif(stddev_pop({x}) OVER (), 0), 0), 6) AS z_{c}")
    return "SELECT session_id, " + ", ".join(cols) + " FROM feat"


@register("feature_matrix", _matrix_sql())
def q_feature_matrix(spark, sf):
    """The 30 model columns standardised (population std)."""
    from ..operators.features import fit_scaler, scaled_columns
    f = C.features_df(spark, sf)
    model = fit_scaler(f)
    out = model.transform(f)
    return out.select("session_id", *[r6(c) for c in scaled_columns(model)])


# ---------------------------------------------------------------------------
# Flagship
# ---------------------------------------------------------------------------

@register("top_sources_by_ports", """
SELECT src_ip, src_connection_count, src_unique_dst_ports, src_unique_dst_ips FROM ss
ORDER BY src_unique_dst_ports DESC, src_connection_count DESC, src_ip LIMIT 20""")
def q_top_sources(spark, sf):
    """Flagship: parse → pair → per-source behaviour → top 20 sources by distinct ports."""
    from ..operators.features import source_stats
    s = source_stats(C.sessions_df(spark, sf))
    return s.orderBy(F.desc("src_unique_dst_ports"), F.desc("src_connection_count"), "src_ip").limit(20)
