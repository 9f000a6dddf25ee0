"""Firewall flows derived from the driver's ``events`` table, and their RT_FLOW rendering.

``flows`` is a deterministic projection of ``events`` (one row per session); the same
SQL runs in DuckDB, so every later stage can be checked against a plan that never saw
text. ``render_lines`` turns the flows into CREATE / CLOSE / DENY syslog lines, which
exercises the real parser. Both are narrow projections: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CREATE_EVENT


def flows(events: DataFrame) -> DataFrame:
    """One session per event row (FIXTURES §6 view)."""
    k = F.regexp_extract("props", r"([0-9]+)", 1).cast("bigint")
    e = events.withColumn("k", k)
    uid, eid, et = F.col("user_id"), F.col("event_id"), F.col("event_type")
    src_ip = F.when(uid % 10 == 0, F.concat(F.lit("203.0.113."), (uid % 254 + 1).cast("string"))) \
        .otherwise(F.concat(F.lit("10.28."), (uid % 7).cast("string"), F.lit("."),
                            (uid % 254 + 1).cast("string")))
    dst_ip = F.when(eid % 4 == 0, F.concat(F.lit("192.168.1."), (F.col("k") + 1).cast("string"))) \
        .otherwise(F.concat(F.lit("8.8."), (eid % 5).cast("string"), F.lit("."),
                            (F.col("k") + 1).cast("string")))
    dst_port = (F.when(et == "click", 443).when(et == "view", 80).when(et == "purchase", 8443)
                .when(et == "signup", 53).otherwise(1000 + (F.col("k") * F.col("k") * 7) % 64000))
    proto = F.when((et == "error") & (F.col("k") % 5 == 0), 1).when(F.col("k") % 3 == 0, 17).otherwise(6)
    close_event = F.when((et == "error") & (F.col("k") % 2 == 0), "RT_FLOW_SESSION_DENY") \
        .otherwise("RT_FLOW_SESSION_CLOSE")
    app = (F.when(et == "click", "junos-https").when(et == "view", "junos-http")
           .when(et == "signup", "junos-dns-udp").otherwise("UNKNOWN"))
    return e.select(
        eid.cast("string").alias("session_id"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("ts_create"),
        F.col("k").alias("dur_s"),
        src_ip.alias("src_ip"),
        dst_ip.alias("dst_ip"),
        (1024 + (eid * 7919) % 60000).cast("int").alias("src_port"),
        dst_port.cast("int").alias("dst_port"),
        proto.cast("int").alias("protocol_num"),
        close_event.alias("close_event"),
        F.when(eid % 11 == 0, 0).otherwise(1).alias("has_create"),
        app.alias("application"),
        F.floor(F.col("value") * 100).cast("bigint").alias("bytes_sent"),
        (F.col("k") * 37).cast("bigint").alias("bytes_rcvd"),
        (1 + F.col("k") % 20).cast("bigint").alias("pkts_sent"),
        (F.col("k") % 13).cast("bigint").alias("pkts_rcvd"),
    )


def syslog_time_text(t: Column) -> Column:
    """'Jan  2 03:04:05': month abbreviation, space-padded day, clock."""
    return F.concat(F.date_format(t, "MMM"), F.lit(" "), F.lpad(F.dayofmonth(t).cast("string"), 2, " "),
                    F.lit(" "), F.date_format(t, "HH:mm:ss"))


def _core(f: DataFrame) -> Column:
    flow = F.concat_ws("", F.col("src_ip"), F.lit("/"), F.col("src_port").cast("string"), F.lit("->"),
                       F.col("dst_ip"), F.lit("/"), F.col("dst_port").cast("string"))
    policy = F.when(F.col("src_port") % 2 == 0, F.lit("source rule offload N/A N/A")) \
        .otherwise(F.lit("N/A N/A N/A N/A"))
    return F.concat_ws(" ", flow, F.lit("0x0"), F.col("application"), flow, F.lit("0x0"), policy,
                       F.col("protocol_num").cast("string"), F.lit("pol untrust SGi"), F.col("session_id"))


def render_lines(f: DataFrame, host: str = "FW1") -> DataFrame:
    """Flows → RT_FLOW syslog lines (``value``) plus ``ord``, the position in a time-ordered log.

    A CREATE line is written when ``has_create = 1``; the end event (CLOSE or DENY) is
    written at ``ts_create + dur_s`` seconds.
    """
    core = _core(f)
    t_end = F.timestamp_add("SECOND", F.col("dur_s"), F.col("ts_create"))
    create = F.concat_ws(" ", syslog_time_text(F.col("ts_create")), F.lit(host),
                         F.lit(f"RT_FLOW: {CREATE_EVENT}: session created"), core,
                         F.lit("N/A(N/A) reth1.1 UNKNOWN"))
    traffic = F.concat(F.col("pkts_sent").cast("string"), F.lit("("), F.col("bytes_sent").cast("string"),
                       F.lit(") "), F.col("pkts_rcvd").cast("string"), F.lit("("),
                       F.col("bytes_rcvd").cast("string"), F.lit(")"))
    end = F.concat_ws(" ", syslog_time_text(t_end), F.lit(host),
                      F.concat(F.lit("RT_FLOW: "), F.col("close_event"), F.lit(": session closed TCP FIN:")),
                      core, traffic, F.lit("1 UNKNOWN"))
    lines = F.array(
        F.when(F.col("has_create") == 1,
               F.struct(create.alias("value"), F.col("ts_create").alias("t"), F.lit(0).alias("kind"))),
        F.struct(end.alias("value"), t_end.alias("t"), F.lit(1).alias("kind")),
    )
    out = f.select(F.col("session_id"), F.explode(lines).alias("l")).where(F.col("l").isNotNull())
    return out.select(
        F.col("l.value").alias("value"),
        F.struct(F.col("l.t").alias("t"), F.col("session_id").cast("bigint").alias("sid"),
                 F.col("l.kind").alias("kind")).alias("ord"),
    )
