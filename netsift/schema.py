"""Schemas and fixed values.

Everything under "FIXED VALUES" must equal the values the analysed firewall
format and the detector definitions use; they are data, not logic.
"""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must stay exactly as listed)
# ---------------------------------------------------------------------------

# Destination ports treated as well known.
WELL_KNOWN_PORTS = [80, 443, 22, 53, 25, 110, 143, 993, 995,
                    21, 23, 3306, 5432, 6379, 27017, 8080, 8443]

# RFC 1918 private ranges, inclusive, as dotted quads.
PRIVATE_RANGES = [
    ("10.0.0.0", "10.255.255.255"),
    ("172.16.0.0", "172.31.255.255"),
    ("192.168.0.0", "192.168.255.255"),
]

# IANA protocol number (as written in the log) -> protocol name.
PROTOCOL_NAMES = {
    "1": "ICMP",
    "6": "TCP",
    "17": "UDP",
    "47": "GRE",
    "50": "ESP",
    "51": "AH",
    "89": "OSPF",
}

# Upper-cased event type -> action; anything else is "unknown".
EVENT_ACTIONS = {
    "RT_FLOW_SESSION_CLOSE": "close",
    "RT_FLOW_SESSION_CREATE": "create",
    "RT_FLOW_SESSION_DENY": "deny",
}

CREATE_EVENT = "RT_FLOW_SESSION_CREATE"
CLOSE_EVENT = "RT_FLOW_SESSION_CLOSE"
DENY_EVENT = "RT_FLOW_SESSION_DENY"

# Hours counted as night.
NIGHT_HOURS = [22, 23, 0, 1, 2, 3, 4, 5, 6]

# Weekday names, Monday first (weekday number 0..6).
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Model input: 30 engineered columns, in this order.
FEATURE_COLUMNS = [
    "log_bytes_sent", "log_bytes_rcvd", "log_bytes_total",
    "log_pkts_sent", "log_pkts_rcvd",
    "log_duration", "log_bytes_per_sec", "log_pkts_per_sec",
    "bytes_ratio", "pkts_ratio", "avg_pkt_size",
    "dst_port", "src_port",
    "is_well_known_port", "is_high_port", "is_privileged_port", "is_rare_dst_port",
    "src_is_private", "dst_is_private",
    "is_outbound", "is_inbound", "is_internal",
    "src_connection_count", "src_unique_dst_ports", "src_unique_dst_ips",
    "protocol_enc", "is_denied",
    "hour", "day_of_week", "is_night",
]

# Columns that get a log1p twin (log_<name>).
LOG_COLUMNS = ["bytes_sent", "bytes_rcvd", "bytes_total", "pkts_sent",
               "pkts_rcvd", "duration", "bytes_per_sec", "pkts_per_sec"]

# Columns of the review export, in order, then two empty review columns.
EXPORT_COLUMNS = [
    "timestamp", "src_ip", "dst_ip", "src_port", "dst_port",
    "protocol", "application", "policy",
    "bytes_sent", "bytes_rcvd", "pkts_sent", "pkts_rcvd",
    "duration", "action",
    "anomaly_score",
]
REVIEW_COLUMNS = ["manual_label", "notes"]

# Traffic columns profiled by histograms and box plots.
TRAFFIC_COLUMNS = ["bytes_sent", "bytes_rcvd", "pkts_sent", "pkts_rcvd"]

# Columns never used as numeric measures (identifiers).
ID_COLUMNS = ["session_id", "protocol_num"]

# Top-k sizes used by the profile and the anomaly summary; export size.
TOP_PROFILE = 15
TOP_SUMMARY = 5
TOP_EXPORT = 100
TOP_CONTRAST = 15

# Detector defaults.
DEFAULT_CONTAMINATION = 0.05
IFOREST_TREES = 200
IFOREST_MAX_SAMPLES = 256
LOF_NEIGHBORS = 20
DBSCAN_EPS = 0.5
DBSCAN_MIN_SAMPLES = 10
AE_HIDDEN = [64, 32]
AE_ENCODING = 8
AE_DROPOUT = 0.2
AE_EPOCHS = 50
AE_BATCH = 256
AE_PATIENCE = 5
AE_VALIDATION = 0.1
SEED = 42

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

# The 24 fields of one RT_FLOW line, in pattern order, with their parsed types.
PARSED_FIELDS = [
    ("timestamp", T.StringType()),
    ("hostname", T.StringType()),
    ("event_type", T.StringType()),
    ("reason_text", T.StringType()),
    ("src_ip", T.StringType()),
    ("src_port", T.LongType()),
    ("dst_ip", T.StringType()),
    ("dst_port", T.LongType()),
    ("application", T.StringType()),
    ("nat_src_ip", T.StringType()),
    ("nat_src_port", T.LongType()),
    ("nat_dst_ip", T.StringType()),
    ("nat_dst_port", T.LongType()),
    ("policy", T.StringType()),
    ("src_zone", T.StringType()),
    ("dst_zone", T.StringType()),
    ("protocol_num", T.LongType()),
    ("src_interface", T.StringType()),
    ("dst_interface", T.StringType()),
    ("session_id", T.StringType()),
    ("pkts_sent", T.LongType()),
    ("bytes_sent", T.LongType()),
    ("pkts_rcvd", T.LongType()),
    ("bytes_rcvd", T.LongType()),
]
PARSED_NAMES = [n for n, _ in PARSED_FIELDS]

EVENT_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t in PARSED_FIELDS]
    + [T.StructField("protocol", T.StringType(), True),
       T.StructField("action", T.StringType(), True),
       T.StructField("duration", T.DoubleType(), True)]
)

SESSION_SCHEMA = T.StructType([f for f in EVENT_SCHEMA.fields if f.name != "hostname"])

# CSV exports of sessions: explicit schema instead of inference.
CSV_SESSION_SCHEMA = SESSION_SCHEMA
