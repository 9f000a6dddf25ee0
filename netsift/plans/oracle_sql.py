"""DuckDB oracle SQL over the driver's views.

The CTE chain below recomputes every stage from ``events`` **without** going through
text: flows → closed sessions with duration → features. Each registered query adds a
final SELECT. All doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

FLOWS = """SELECT CAST(event_id AS VARCHAR) AS session_id,
       date_trunc('second', ts) AS ts_create,
       k AS dur_s,
       CASE WHEN user_id % 10 = 0 THEN concat('203.0.113.', CAST(user_id % 254 + 1 AS VARCHAR))
            ELSE concat('10.28.', CAST(user_id % 7 AS VARCHAR), '.', CAST(user_id % 254 + 1 AS VARCHAR)) END AS src_ip,
       CASE WHEN event_id % 4 = 0 THEN concat('192.168.1.', CAST(k + 1 AS VARCHAR))
            ELSE concat('8.8.', CAST(event_id % 5 AS VARCHAR), '.', CAST(k + 1 AS VARCHAR)) END AS dst_ip,
       CAST(1024 + (event_id * 7919) % 60000 AS INT) AS src_port,
       CAST(CASE event_type WHEN 'click' THEN 443 WHEN 'view' THEN 80 WHEN 'purchase' THEN 8443
            WHEN 'signup' THEN 53 ELSE 1000 + (k * k * 7) % 64000 END AS INT) AS dst_port,
       CAST(CASE WHEN event_type = 'error' AND k % 5 = 0 THEN 1 WHEN k % 3 = 0 THEN 17 ELSE 6 END AS INT) AS protocol_num,
       CASE WHEN event_type = 'error' AND k % 2 = 0 THEN 'RT_FLOW_SESSION_DENY' ELSE 'RT_FLOW_SESSION_CLOSE' END AS close_event,
       CASE WHEN event_id % 11 = 0 THEN 0 ELSE 1 END AS has_create,
       CASE event_type WHEN 'click' THEN 'junos-https' WHEN 'view' THEN 'junos-http' WHEN 'signup' THEN 'junos-dns-udp' ELSE 'UNKNOWN' END AS application,
       CAST(floor(value * 100) AS BIGINT) AS bytes_sent,
       CAST(k * 37 AS BIGINT) AS bytes_rcvd,
       CAST(1 + k % 20 AS BIGINT) AS pkts_sent,
       CAST(k % 13 AS BIGINT) AS pkts_rcvd
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) e"""


def syslog_text(t: str) -> str:
    return (f"(strftime({t}, '%b') || ' ' || lpad(CAST(day({t}) AS VARCHAR), 2, ' ') || ' ' "
            f"|| strftime({t}, '%H:%M:%S'))")


def ip_int(c: str) -> str:
    parts = [f"TRY_CAST(split_part({c}, '.', {i}) AS BIGINT) * {w}"
             for i, w in zip(range(1, 5), [16777216, 65536, 256, 1])]
    return "COALESCE(" + " + ".join(parts) + ", 0)"


def is_private(c: str) -> str:
    x = ip_int(c)
    return (f"CAST(({x}) BETWEEN 167772160 AND 184549375 OR ({x}) BETWEEN 2886729728 AND 2887778303 "
            f"OR ({x}) BETWEEN 3232235520 AND 3232301055 AS INTEGER)")


PROTO = ("CASE protocol_num WHEN 1 THEN 'ICMP' WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' WHEN 47 THEN 'GRE' "
         "WHEN 50 THEN 'ESP' WHEN 51 THEN 'AH' WHEN 89 THEN 'OSPF' ELSE CAST(protocol_num AS VARCHAR) END")

WELL_KNOWN = "80, 443, 22, 53, 25, 110, 143, 993, 995, 21, 23, 3306, 5432, 6379, 27017, 8080, 8443"


def _events_cte() -> str:
    """Parsed events (CREATE + end events) as the parser must produce them."""
    core = """src_ip, src_port, dst_ip, dst_port, application,
      src_ip AS nat_src_ip, src_port AS nat_src_port, dst_ip AS nat_dst_ip, dst_port AS nat_dst_port,
      CASE WHEN src_port % 2 = 0 THEN 'offload' END AS policy,
      CAST(NULL AS VARCHAR) AS src_zone, CAST(NULL AS VARCHAR) AS dst_zone, protocol_num,
      'pol' AS src_interface, 'untrust' AS dst_interface, session_id"""
    return f"""parsed AS (
  SELECT {syslog_text('ts_create')} AS timestamp, 'FW1' AS hostname, 'RT_FLOW_SESSION_CREATE' AS event_type,
      'session created' AS reason_text, {core},
      CAST(0 AS BIGINT) AS pkts_sent, CAST(0 AS BIGINT) AS bytes_sent, CAST(0 AS BIGINT) AS pkts_rcvd,
      CAST(0 AS BIGINT) AS bytes_rcvd, {PROTO} AS protocol, 'create' AS action, CAST(0 AS DOUBLE) AS duration,
      ts_create AS ts
  FROM flows WHERE has_create = 1
  UNION ALL
  SELECT {syslog_text('ts_create + to_seconds(dur_s)')} AS timestamp, 'FW1' AS hostname, close_event AS event_type,
      'session closed TCP FIN:' AS reason_text, {core},
      pkts_sent, bytes_sent, pkts_rcvd, bytes_rcvd, {PROTO} AS protocol,
      CASE close_event WHEN 'RT_FLOW_SESSION_CLOSE' THEN 'close' ELSE 'deny' END AS action,
      CAST(0 AS DOUBLE) AS duration, ts_create + to_seconds(dur_s) AS ts
  FROM flows
)"""


SESSION_COLS = ("timestamp, event_type, reason_text, src_ip, src_port, dst_ip, dst_port, application, "
                "nat_src_ip, nat_src_port, nat_dst_ip, nat_dst_port, policy, src_zone, dst_zone, protocol_num, "
                "src_interface, dst_interface, session_id, pkts_sent, bytes_sent, pkts_rcvd, bytes_rcvd, "
                "protocol, action, duration")


def _sessions_cte() -> str:
    return f"""closed AS (
  SELECT *, ts_create + to_seconds(dur_s) AS ts_close FROM flows
  WHERE close_event = 'RT_FLOW_SESSION_CLOSE' AND dst_port <> 53 AND protocol_num <> 1
),
med AS (SELECT median(CAST(dur_s AS DOUBLE)) AS m FROM closed WHERE has_create = 1),
sessions_all AS (
  SELECT p.timestamp, p.event_type, p.reason_text, p.src_ip, p.src_port, p.dst_ip, p.dst_port, p.application,
         p.nat_src_ip, p.nat_src_port, p.nat_dst_ip, p.nat_dst_port, p.policy, p.src_zone, p.dst_zone,
         p.protocol_num, p.src_interface, p.dst_interface, p.session_id, p.pkts_sent, p.bytes_sent,
         p.pkts_rcvd, p.bytes_rcvd, p.protocol, p.action,
         CASE WHEN c.has_create = 1 THEN CAST(c.dur_s AS DOUBLE) ELSE med.m END AS duration,
         c.has_create, c.ts_close
  FROM closed c JOIN parsed p ON p.session_id = c.session_id AND p.event_type = 'RT_FLOW_SESSION_CLOSE'
  CROSS JOIN med
),
sessions AS (SELECT * FROM sessions_all WHERE duration IS DISTINCT FROM 0)"""


def _features_cte() -> str:
    return f"""pc AS (SELECT dst_port, count(*) AS n FROM sessions GROUP BY dst_port),
thr AS (SELECT quantile_cont(n, 0.1) AS q FROM pc),
ss AS (SELECT src_ip, count(dst_port) AS src_connection_count,
              count(DISTINCT dst_port) AS src_unique_dst_ports, count(DISTINCT dst_ip) AS src_unique_dst_ips
       FROM sessions WHERE src_ip IS NOT NULL GROUP BY src_ip),
pidx AS (SELECT p, CAST(dense_rank() OVER (ORDER BY p) - 1 AS INTEGER) AS protocol_enc
         FROM (SELECT DISTINCT coalesce(protocol, 'UNKNOWN') AS p FROM sessions)),
feat0 AS (
  SELECT s.*,
    s.bytes_sent + s.bytes_rcvd AS bytes_total,
    s.pkts_sent + s.pkts_rcvd AS pkts_total,
    CAST(s.bytes_sent AS DOUBLE) / (s.bytes_rcvd + 1) AS bytes_ratio,
    CAST(s.pkts_sent AS DOUBLE) / (s.pkts_rcvd + 1) AS pkts_ratio,
    CAST(s.bytes_sent + s.bytes_rcvd AS DOUBLE) / (s.duration + 1) AS bytes_per_sec,
    CAST(s.pkts_sent + s.pkts_rcvd AS DOUBLE) / (s.duration + 1) AS pkts_per_sec,
    CAST(s.bytes_sent + s.bytes_rcvd AS DOUBLE) / (s.pkts_sent + s.pkts_rcvd + 1) AS avg_pkt_size,
    CAST(s.dst_port IN ({WELL_KNOWN}) AS INTEGER) AS is_well_known_port,
    CAST(s.dst_port > 1024 AS INTEGER) AS is_high_port,
    CAST(s.dst_port < 1024 AS INTEGER) AS is_privileged_port,
    CAST(pc.n <= thr.q AS INTEGER) AS is_rare_dst_port,
    {is_private('s.src_ip')} AS src_is_private,
    {is_private('s.dst_ip')} AS dst_is_private,
    ss.src_connection_count, ss.src_unique_dst_ports, ss.src_unique_dst_ips,
    pidx.protocol_enc,
    CAST(coalesce(lower(s.action) = 'deny', false) AS INTEGER) AS is_denied,
    s.ts_close AS ts,
    CAST(hour(s.ts_close) AS INTEGER) AS hour,
    CAST(isodow(s.ts_close) - 1 AS INTEGER) AS day_of_week,
    CAST(coalesce(hour(s.ts_close) >= 22 OR hour(s.ts_close) <= 6, false) AS INTEGER) AS is_night
  FROM sessions s
  JOIN pc ON pc.dst_port = s.dst_port CROSS JOIN thr
  LEFT JOIN ss ON ss.src_ip = s.src_ip
  JOIN pidx ON pidx.p = coalesce(s.protocol, 'UNKNOWN')
),
feat AS (
  SELECT *,
    CAST(src_is_private = 1 AND dst_is_private = 0 AS INTEGER) AS is_outbound,
    CAST(src_is_private = 0 AND dst_is_private = 1 AS INTEGER) AS is_inbound,
    CAST(src_is_private = 1 AND dst_is_private = 1 AS INTEGER) AS is_internal,
    ln(1 + CAST(bytes_sent AS DOUBLE)) AS log_bytes_sent, ln(1 + CAST(bytes_rcvd AS DOUBLE)) AS log_bytes_rcvd,
    ln(1 + CAST(bytes_total AS DOUBLE)) AS log_bytes_total, ln(1 + CAST(pkts_sent AS DOUBLE)) AS log_pkts_sent,
    ln(1 + CAST(pkts_rcvd AS DOUBLE)) AS log_pkts_rcvd, ln(1 + duration) AS log_duration,
    ln(1 + bytes_per_sec) AS log_bytes_per_sec, ln(1 + pkts_per_sec) AS log_pkts_per_sec
  FROM feat0
)"""


def base_with() -> str:
    """WITH clause shared by every oracle query (DuckDB inlines only what is used)."""
    return ("WITH flows AS (\n" + FLOWS + "\n),\n" + _events_cte() + ",\n" + _sessions_cte() + ",\n"
            + _features_cte() + "\n")


def r6(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"
