"""Registered profile, metric, export and threat queries (+ oracle SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import export as X
from ..operators import metrics as M
from ..operators import profile as P
from ..operators import threats as TH
from ..functions.timefn import syslog_timestamp
from ..schema import FEATURE_COLUMNS, SESSION_SCHEMA, TRAFFIC_COLUMNS
from . import catalog as C
from .oracle_sql import is_private
from .registry import r6, register

GBD = "1073741824.0"

# ---------------------------------------------------------------------------
# Profile (A6-A17)
# ---------------------------------------------------------------------------


@register("basic_stats", f"""
SELECT count(*) AS n_sessions, min(ts) AS ts_min, max(ts) AS ts_max,
       count(DISTINCT src_ip) AS n_src_ip, count(DISTINCT dst_ip) AS n_dst_ip,
       count(DISTINCT application) AS n_application,
       CAST(floor(date_diff('second', min(ts), max(ts)) / 86400) AS BIGINT) AS span_days,
       round(CAST(sum(bytes_sent) + sum(bytes_rcvd) AS DOUBLE) / {GBD}, 6) AS total_gb,
       round(CAST(sum(bytes_sent) + sum(bytes_rcvd) AS DOUBLE) / count(*) / 1024.0, 6) AS mean_kb
FROM feat""")
def q_basic_stats(spark, sf):
    """Dataset profile."""
    return P.basic_stats(C.timed_sessions(spark, sf))


def _census_sql() -> str:
    parts = []
    for i, f in enumerate(SESSION_SCHEMA.fields):
        parts.append(f"SELECT {i} AS position, '{f.name}' AS column, '{f.dataType.simpleString()}' AS dtype, "
                     f"count({f.name}) AS non_null, count(*) AS n_rows FROM sessions")
    return "\nUNION ALL ".join(parts)


@register("frame_census", _census_sql())
def q_frame_census(spark, sf):
    """Column, type, non-null count per column of the closed-session table."""
    s = C.sessions_df(spark, sf)
    return P.frame_census(s.select(*[f.name for f in SESSION_SCHEMA.fields]))


@register("protocol_counts", """
SELECT protocol, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM feat), 6) AS pct
FROM feat WHERE protocol IS NOT NULL GROUP BY protocol ORDER BY n DESC, protocol LIMIT 5""")
def q_protocol_counts(spark, sf):
    """Top 5 protocols with percent of sessions."""
    return P.value_counts(C.timed_sessions(spark, sf), "protocol", top=5)


@register("action_counts", """
SELECT action, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM parsed), 6) AS pct
FROM parsed WHERE action IS NOT NULL GROUP BY action""")
def q_action_counts(spark, sf):
    """All actions with percent, over the parsed events."""
    return P.value_counts(C.parsed_events(spark, sf), "action")


@register("traffic_hourly", f"""
, b AS (SELECT date_trunc('hour', ts) AS bin, count(*) AS sessions, CAST(sum(bytes_sent) AS BIGINT) AS bytes_sent,
               CAST(sum(bytes_rcvd) AS BIGINT) AS bytes_rcvd FROM feat GROUP BY 1),
axis AS (SELECT unnest(generate_series(min(bin), max(bin), INTERVAL 1 HOUR)) AS bin FROM b)
SELECT axis.bin, coalesce(sessions, 0) AS sessions, coalesce(bytes_sent, 0) AS bytes_sent,
       coalesce(bytes_rcvd, 0) AS bytes_rcvd,
       round(coalesce(bytes_sent, 0) / {GBD}, 9) AS gb_sent, round(coalesce(bytes_rcvd, 0) / {GBD}, 9) AS gb_rcvd
FROM axis LEFT JOIN b USING (bin)""")
def q_traffic_hourly(spark, sf):
    """Sessions and bytes per hour, empty hours as 0."""
    return P.traffic_timeline(C.timed_sessions(spark, sf), "hour")


def _pivot_sql() -> str:
    names = "CASE day_of_week " + " ".join(
        f"WHEN {i} THEN '{n}'" for i, n in enumerate(["Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                                                     "Saturday", "Sunday"])) + " END"
    hs = ", ".join(f"count(*) FILTER (WHERE hour = {h}) AS h{h:02d}" for h in range(24))
    return f"SELECT {names} AS day_name, day_of_week, {hs} FROM feat GROUP BY day_of_week"


@register("activity_pivot", _pivot_sql())
def q_activity_pivot(spark, sf):
    """Sessions per weekday × hour."""
    return P.activity_pivot(C.timed_sessions(spark, sf))


def _hist_sql(log: bool) -> str:
    val = (lambda c: f"ln(1 + CAST({c} AS DOUBLE))") if log else (lambda c: f"CAST({c} AS DOUBLE)")
    u = " UNION ALL ".join(f"SELECT '{c}' AS feature, {val(c)} AS x FROM feat" for c in TRAFFIC_COLUMNS)
    return f"""
, l AS (SELECT * FROM ({u}) WHERE x IS NOT NULL AND NOT isnan(x)),
rng0 AS (SELECT feature, min(x) AS mn, max(x) AS mx FROM l GROUP BY feature),
rng AS (SELECT feature, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
                        CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM rng0),
cnt AS (SELECT l.feature, least(CAST(floor((x - lo) / (hi - lo) * 50) AS INTEGER), 49) AS bin, count(*) AS n
        FROM l JOIN rng USING (feature) GROUP BY ALL),
axis AS (SELECT feature, lo, hi, CAST(unnest(generate_series(0, 49)) AS INTEGER) AS bin FROM rng)
SELECT axis.feature, axis.bin, round(lo + bin * ((hi - lo) / 50), 6) AS bin_lo,
       round(lo + (bin + 1) * ((hi - lo) / 50), 6) AS bin_hi, coalesce(n, 0) AS n
FROM axis LEFT JOIN cnt USING (feature, bin)"""


@register("hist_50", _hist_sql(False))
def q_hist_50(spark, sf):
    """50-bin histograms of bytes/pkts sent/rcvd."""
    return P.histograms(C.timed_sessions(spark, sf))


@register("hist_log_50", _hist_sql(True))
def q_hist_log_50(spark, sf):
    """50-bin histograms of log1p(bytes/pkts sent/rcvd)."""
    return P.histograms(C.timed_sessions(spark, sf), log1p=True)


# Every numeric column of the feature table (``P.numeric_columns``; a test holds the two equal).
CORR_COLUMNS = ["dst_port", "src_port", "nat_src_port", "nat_dst_port", "pkts_sent", "bytes_sent", "pkts_rcvd", "bytes_rcvd",
                "duration", "bytes_total", "pkts_total", "bytes_ratio", "pkts_ratio", "bytes_per_sec", "pkts_per_sec",
                "avg_pkt_size", "is_well_known_port", "is_high_port", "is_privileged_port", "is_rare_dst_port",
                "src_is_private", "dst_is_private", "is_outbound", "is_inbound", "is_internal", "src_connection_count",
                "src_unique_dst_ports", "src_unique_dst_ips", "protocol_enc", "is_denied", "hour", "day_of_week", "is_night",
                "log_bytes_sent", "log_bytes_rcvd", "log_pkts_sent", "log_pkts_rcvd", "log_bytes_total", "log_duration",
                "log_bytes_per_sec", "log_pkts_per_sec"]


def _corr_sql() -> str:
    cols = ", ".join(f"{{'i': {i}, 'name': '{c}', 'v': CAST({c} AS DOUBLE)}}" for i, c in enumerate(CORR_COLUMNS))
    return f""", numbered AS (SELECT row_number() OVER () AS r, [{cols}] AS l FROM feat),
long AS (SELECT r, c.i AS i, c.name AS name, c.v AS v FROM (SELECT r, unnest(l) AS c FROM numbered) WHERE c.v IS NOT NULL)
SELECT a.name AS col_a, b.name AS col_b,
       round(covar_pop(a.v, b.v) / nullif(stddev_pop(a.v) * stddev_pop(b.v), 0), 6) AS corr
FROM long a JOIN long b ON a.r = b.r AND b.i < a.i GROUP BY a.name, b.name"""


@register("corr_matrix", _corr_sql())
def q_corr_matrix(spark, sf):
    """Pairwise Pearson correlations (lower triangle) of the numeric features."""
    return P.corr_matrix(C.features_df(spark, sf), CORR_COLUMNS)


def _top_sql(src: str, cols, k: int, where: str = "") -> str:
    u = " UNION ALL ".join(f"SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS value FROM {src} {where}"
                           for c in cols)
    return f"""
, tl AS (SELECT * FROM ({u}) WHERE value IS NOT NULL),
tc AS (SELECT dimension, value, count(*) AS n FROM tl GROUP BY ALL),
tr AS (SELECT *, CAST(row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value) AS INTEGER) AS rank FROM tc)
SELECT dimension, rank, value, n FROM tr WHERE rank <= {k}"""


@register("top15", _top_sql("feat", ["src_ip", "dst_ip", "dst_port", "application"], 15))
def q_top15(spark, sf):
    """Top 15 sources, destinations, ports, applications by sessions."""
    return P.top_values(C.timed_sessions(spark, sf))


def _iqr_sql() -> str:
    parts = []
    for c in TRAFFIC_COLUMNS:
        parts.append(f"""SELECT '{c}' AS feature, q1, median, q3, iqr, lf AS lower_fence, uf AS upper_fence,
   (SELECT min({c}) FROM feat WHERE {c} >= lf) AS whisker_low, (SELECT max({c}) FROM feat WHERE {c} <= uf) AS whisker_high,
   (SELECT count(*) FROM feat WHERE {c} < lf OR {c} > uf) AS n_outliers,
   (SELECT count(*) FROM feat WHERE {c} < lf OR {c} > uf) * 100.0 / (SELECT count(*) FROM feat) AS pct
 FROM (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM
   (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median,
           quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM feat))""")
    inner = "\nUNION ALL ".join(parts)
    cols = ", ".join(f"round(CAST({k} AS DOUBLE), 6) AS {k}" for k in
                     ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "whisker_low", "whisker_high"])
    return f"SELECT feature, {cols}, n_outliers, round(pct, 6) AS pct_outliers FROM ({inner})"


@register("iqr_outliers", _iqr_sql())
def q_iqr_outliers(spark, sf):
    """Quartiles, IQR fences, whiskers and outlier counts of the traffic columns."""
    return P.iqr_outliers(C.timed_sessions(spark, sf))


@register("class_dist", """
SELECT toxic AS class, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM labels GROUP BY toxic""")
def q_class_dist(spark, sf):
    """Class counts and shares (labels.toxic)."""
    return P.class_distribution(C.table(spark, sf, "labels"), "toxic")


# ---------------------------------------------------------------------------
# Scored sessions: per-session exfiltration indicator (bytes out / in, p95)
# ---------------------------------------------------------------------------

SCORED_CTE = """
, sc0 AS (SELECT *, CAST(bytes_sent AS DOUBLE) / (bytes_rcvd + 1.0) AS anomaly_score FROM feat),
sthr AS (SELECT quantile_cont(anomaly_score, 0.95) AS t FROM sc0),
scored AS (SELECT sc0.*, CAST(coalesce(anomaly_score > t, false) AS INTEGER) AS is_anomaly FROM sc0, sthr)"""


def scored(spark, sf, pct: float = 95.0):
    return TH.ratio_scores(C.features_df(spark, sf), pct)


@register("label_census", SCORED_CTE + """
SELECT is_anomaly AS prediction, count(*) AS n, round(min(anomaly_score), 6) AS min_score,
       round(max(anomaly_score), 6) AS max_score FROM scored GROUP BY 1""")
def q_label_census(spark, sf):
    """Per predicted label, rows and score range."""
    return P.label_census(scored(spark, sf))


@register("unsup_result", SCORED_CTE + """
SELECT 'exfil_ratio_p95' AS model, CAST(sum(is_anomaly) AS BIGINT) AS n_anomalies,
       round(avg(CAST(is_anomaly AS DOUBLE)) * 100, 6) AS anomaly_rate FROM scored""")
def q_unsup_result(spark, sf):
    """Anomalies and rate for one detector."""
    return M.unsupervised_result(scored(spark, sf), "exfil_ratio_p95")


@register("model_ranking", SCORED_CTE + """
, s99 AS (SELECT quantile_cont(anomaly_score, 0.99) AS t FROM sc0),
r AS (
  SELECT 'exfil_ratio_p95' AS model, CAST(sum(is_anomaly) AS BIGINT) AS n_anomalies,
         round(avg(CAST(is_anomaly AS DOUBLE)) * 100, 6) AS anomaly_rate FROM scored
  UNION ALL
  SELECT 'exfil_ratio_p99', CAST(sum(CAST(anomaly_score > t AS INTEGER)) AS BIGINT),
         round(avg(CAST(anomaly_score > t AS DOUBLE)) * 100, 6) FROM sc0, s99
  UNION ALL
  SELECT 'rare_port', CAST(sum(is_rare_dst_port) AS BIGINT), round(avg(CAST(is_rare_dst_port AS DOUBLE)) * 100, 6)
  FROM feat)
SELECT *, round(abs(anomaly_rate - 5.0), 6) AS rate_deviation FROM r""")
def q_model_ranking(spark, sf):
    """Detectors ranked by |anomaly rate − 5 %|."""
    f = C.features_df(spark, sf)
    r = [M.unsupervised_result(TH.ratio_scores(f, 95.0), "exfil_ratio_p95"),
         M.unsupervised_result(TH.ratio_scores(f, 99.0), "exfil_ratio_p99"),
         M.unsupervised_result(f, "rare_port", pred="is_rare_dst_port")]
    return X.compare_unsupervised(r)


@register("top_anomalies", SCORED_CTE + """
SELECT ts AS timestamp, src_ip, dst_ip, src_port, dst_port, protocol, application, policy, bytes_sent, bytes_rcvd,
       pkts_sent, pkts_rcvd, round(duration, 6) AS duration, action, round(anomaly_score, 6) AS anomaly_score,
       '' AS manual_label, '' AS notes
FROM scored WHERE is_anomaly = 1 ORDER BY anomaly_score DESC, session_id LIMIT 100""")
def q_top_anomalies(spark, sf):
    """Top 100 anomalies for manual review."""
    t = X.top_anomalies(scored(spark, sf))
    return t.select(*[r6(c) if c in ("duration", "anomaly_score") else c for c in t.columns])


@register("anomaly_summary", SCORED_CTE + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE is_anomaly = 1) AS n_anomalies,
       round(count(*) FILTER (WHERE is_anomaly = 1) * 100.0 / count(*), 6) AS pct_anomalies,
       round(avg(anomaly_score) FILTER (WHERE is_anomaly = 1), 6) AS mean_anomaly_score,
       round(max(anomaly_score), 6) AS max_score,
       count(*) FILTER (WHERE is_anomaly = 1 AND hour IN (22, 23, 0, 1, 2, 3, 4, 5, 6)) AS n_night,
       count(*) FILTER (WHERE is_anomaly = 1 AND NOT coalesce(hour IN (22, 23, 0, 1, 2, 3, 4, 5, 6), false)) AS n_day,
       round(count(*) FILTER (WHERE is_anomaly = 1 AND hour IN (22, 23, 0, 1, 2, 3, 4, 5, 6)) * 100.0
             / nullif(count(*) FILTER (WHERE is_anomaly = 1), 0), 6) AS pct_night,
       round(count(*) FILTER (WHERE is_anomaly = 1 AND NOT coalesce(hour IN (22, 23, 0, 1, 2, 3, 4, 5, 6), false)) * 100.0
             / nullif(count(*) FILTER (WHERE is_anomaly = 1), 0), 6) AS pct_day
FROM scored""")
def q_anomaly_summary(spark, sf):
    """Anomaly headline numbers and night/day split."""
    return X.anomaly_summary(scored(spark, sf))


@register("anomaly_top_values", SCORED_CTE + _top_sql("scored", ["src_ip", "dst_port", "application"], 5,
                                                      "WHERE is_anomaly = 1").replace(
    "SELECT dimension, rank, value, n FROM tr WHERE rank <= 5",
    "SELECT dimension, rank, value, n, round(n * 100.0 / (SELECT count(*) FROM scored WHERE is_anomaly = 1), 6)"
    " AS pct_of_anomalies FROM tr WHERE rank <= 5"))
def q_anomaly_top_values(spark, sf):
    """Top 5 sources, ports and applications among anomalies."""
    return X.anomaly_top_values(scored(spark, sf))


@register("timeline_minute", SCORED_CTE + """
, b AS (SELECT date_trunc('minute', ts) AS bin, count(*) AS sessions, CAST(sum(bytes_sent) AS BIGINT) AS bytes_sent,
               CAST(sum(bytes_rcvd) AS BIGINT) AS bytes_rcvd, count(*) FILTER (WHERE is_anomaly = 1) AS anomalies
        FROM scored GROUP BY 1),
axis AS (SELECT unnest(generate_series(min(bin), max(bin), INTERVAL 1 MINUTE)) AS bin FROM b)
SELECT axis.bin, coalesce(sessions, 0) AS sessions, coalesce(bytes_sent, 0) AS bytes_sent,
       coalesce(bytes_rcvd, 0) AS bytes_rcvd, coalesce(anomalies, 0) AS anomalies,
       round(coalesce(bytes_sent, 0) / 1073741824.0, 9) AS gb_sent, round(coalesce(bytes_rcvd, 0) / 1073741824.0, 9) AS gb_rcvd
FROM axis LEFT JOIN b USING (bin)""")
def q_timeline_minute(spark, sf):
    """Events and anomalies per minute, gap-filled."""
    return P.traffic_timeline(scored(spark, sf), "minute", flag="is_anomaly")


def _contrast_sql() -> str:
    zs = []
    for c in FEATURE_COLUMNS:
        x = f"coalesce(CAST({c} AS DOUBLE), 0)"
        zs.append(f"coalesce(({x} - avg({x}) OVER ()) / nullif(stddev_pop({x}) OVER (), 0), 0) AS z_{c}")
    z = "SELECT is_anomaly, " + ", ".join(zs) + " FROM scored"
    u = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(z_{c}) FILTER (WHERE is_anomaly <> 1) AS mean_normal, "
        f"avg(z_{c}) FILTER (WHERE is_anomaly = 1) AS mean_anomaly FROM zz" for c in FEATURE_COLUMNS)
    return (SCORED_CTE + f", zz AS ({z}), lng AS ({u}) SELECT feature, round(mean_normal, 6) AS mean_normal, "
            "round(mean_anomaly, 6) AS mean_anomaly, round(abs(mean_anomaly - mean_normal), 6) AS abs_diff "
            "FROM lng ORDER BY abs(mean_anomaly - mean_normal) DESC, feature LIMIT 15")


@register("feature_contrast", _contrast_sql())
def q_feature_contrast(spark, sf):
    """Scaled-feature means of anomalies vs normal rows, top 15 differences."""
    from ..operators.features import fit_scaler, scaled_columns
    s = scored(spark, sf)
    model = fit_scaler(s)
    z = model.transform(s)
    cols = scaled_columns(model)
    out = M.feature_contrast(z, cols)
    return out.withColumn("feature", F.regexp_replace("feature", "^z_", ""))


# ---------------------------------------------------------------------------
# Supervised metrics on labels ⋈ documents (y = toxic, score = n_chars)
# ---------------------------------------------------------------------------

LAB_CTE = """
, lab0 AS (SELECT l.toxic AS y, CAST(d.n_chars AS DOUBLE) AS score FROM labels l JOIN documents d USING (doc_id)),
lthr AS (SELECT quantile_cont(score, 0.95) AS t FROM lab0),
lab AS (SELECT y, score, CAST(coalesce(score > t, false) AS INTEGER) AS pred FROM lab0, lthr),
st AS (SELECT score AS s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
       FROM lab GROUP BY score),
st2 AS (SELECT s, pos, neg,
          coalesce(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_above,
          coalesce(sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_above,
          sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM st),
cm AS (SELECT count(*) FILTER (WHERE y <> 1 AND pred <> 1) AS tn, count(*) FILTER (WHERE y <> 1 AND pred = 1) AS fp,
              count(*) FILTER (WHERE y = 1 AND pred <> 1) AS fn, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp FROM lab)"""


def labelled(spark, sf):
    lab = C.table(spark, sf, "labels").join(C.table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    lab = lab.select(F.col("toxic").alias("y"), F.col("n_chars").cast("double").alias("score"))
    return M.flag_above(lab, "score", 95.0, out="pred").drop("threshold")


@register("confusion", LAB_CTE + " SELECT tn, fp, fn, tp FROM cm")
def q_confusion(spark, sf):
    """Confusion matrix."""
    return M.confusion(labelled(spark, sf))


@register("prf", LAB_CTE + """
, p AS (SELECT *, tp / (tp + fp + 1e-9) AS precision, tp / (tp + fn + 1e-9) AS recall FROM cm)
SELECT tn, fp, fn, tp, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(2 * precision * recall / (precision + recall + 1e-9), 6) AS f1 FROM p""")
def q_prf(spark, sf):
    """Precision / recall / F1 with the 1e-9 guard."""
    return M.prf(labelled(spark, sf))


@register("roc_auc", LAB_CTE + """
SELECT round(sum(neg * (pos_above + pos / 2.0)) / (max(P) * max(N)), 6) AS roc_auc FROM st2""")
def q_roc_auc(spark, sf):
    """Exact tie-aware ROC-AUC."""
    return M.roc_auc(labelled(spark, sf))


@register("avg_precision", LAB_CTE + """
SELECT round(sum(CASE WHEN pos > 0 THEN (pos / P) * ((pos_above + pos) / (pos_above + pos + neg_above + neg)) END), 6)
       AS avg_precision FROM st2""")
def q_avg_precision(spark, sf):
    """Step-wise average precision."""
    return M.average_precision(labelled(spark, sf))


@register("roc_points", LAB_CTE + """
SELECT s AS threshold, round((neg_above + neg) / N, 6) AS fpr, round((pos_above + pos) / P, 6) AS tpr FROM st2""")
def q_roc_points(spark, sf):
    """ROC curve points per distinct score."""
    return M.roc_points(labelled(spark, sf))


@register("pr_points", LAB_CTE + """
SELECT s AS threshold, round((pos_above + pos) / (pos_above + pos + neg_above + neg), 6) AS precision,
       round((pos_above + pos) / P, 6) AS recall FROM st2""")
def q_pr_points(spark, sf):
    """Precision-recall curve points per distinct score."""
    return M.pr_points(labelled(spark, sf))


@register("class_report", LAB_CTE + """
, c AS (SELECT coalesce(tn / nullif(CAST(tn + fn AS DOUBLE), 0), 0) AS p0, coalesce(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 0) AS r0,
               tn + fp AS s0, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS p1,
               coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS r1, tp + fn AS s1,
               coalesce((tp + tn) / nullif(CAST(tn + fp + fn + tp AS DOUBLE), 0), 0) AS acc FROM cm),
c2 AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1 FROM c),
rows AS (
  SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM c2
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM c2
  UNION ALL SELECT 'accuracy', acc, acc, acc, s0 + s1 FROM c2
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM c2
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
                   (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM c2)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM rows""")
def q_class_report(spark, sf):
    """Per-class report with accuracy, macro and weighted means."""
    return M.class_report(labelled(spark, sf))


@register("score_density", LAB_CTE + """
, x AS (SELECT CAST(y AS VARCHAR) AS grp, score AS x FROM lab WHERE score IS NOT NULL),
r0 AS (SELECT grp, min(x) AS mn, max(x) AS mx, count(*) AS tot FROM x GROUP BY grp),
r AS (SELECT grp, tot, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM r0),
cnt AS (SELECT x.grp, least(CAST(floor((x - lo) / (hi - lo) * 80) AS INTEGER), 79) AS bin, count(*) AS n
        FROM x JOIN r USING (grp) GROUP BY ALL),
axis AS (SELECT grp, lo, hi, tot, CAST(unnest(generate_series(0, 79)) AS INTEGER) AS bin FROM r)
SELECT axis.grp AS class, axis.bin, round(lo + bin * ((hi - lo) / 80), 6) AS bin_lo, coalesce(n, 0) AS n,
       round(coalesce(n, 0) / (tot * ((hi - lo) / 80)), 6) AS density
FROM axis LEFT JOIN cnt USING (grp, bin)""")
def q_score_density(spark, sf):
    """Per-class score density, 80 bins."""
    return M.score_density(labelled(spark, sf), "score", label="y")


@register("model_comparison", LAB_CTE + """
, q AS (SELECT tp / (tp + fp + 1e-9) AS precision, tp / (tp + fn + 1e-9) AS recall FROM cm),
m AS (SELECT 'n_chars' AS model, precision, recall, 2 * precision * recall / (precision + recall + 1e-9) AS f1,
             (SELECT sum(neg * (pos_above + pos / 2.0)) / (max(P) * max(N)) FROM st2) AS roc_auc,
             (SELECT sum(CASE WHEN pos > 0 THEN (pos / P) * ((pos_above + pos) / (pos_above + pos + neg_above + neg)) END) FROM st2)
               AS avg_precision FROM q)
SELECT model, metric, round(value, 6) AS value FROM m
UNPIVOT (value FOR metric IN (precision, recall, f1, roc_auc, avg_precision))""")
def q_model_comparison(spark, sf):
    """Supervised comparison table (model, metric, value)."""
    lab = labelled(spark, sf)
    p = M.prf(lab).select("precision", "recall", "f1")
    row = p.crossJoin(M.ranking_metrics(lab)).withColumn("model", F.lit("n_chars"))
    return M.supervised_comparison([row])


# ---------------------------------------------------------------------------
# Threat rules (thresholds sized for the fixture's sparse traffic)
# ---------------------------------------------------------------------------


def _bucket(expr: str, seconds: int) -> str:
    return f"make_timestamp(CAST(floor(epoch_us({expr}) / {seconds}e6) * {seconds}e6 AS BIGINT))"


# The rules read every ended attempt, so that scans and floods the firewall denied count too.
ENDED_CTE = """
, ended AS (SELECT *, ts_create + to_seconds(dur_s) AS ts FROM flows WHERE dst_port <> 53 AND protocol_num <> 1)"""


@register("threat_ddos", ENDED_CTE + f"""
SELECT {_bucket('ts', 3600)} AS window_start, src_ip, count(*) AS connections,
       CAST(sum(pkts_sent + pkts_rcvd) AS BIGINT) AS packets
FROM ended GROUP BY ALL HAVING count(*) >= 2 OR sum(pkts_sent + pkts_rcvd) >= 60""")
def q_threat_ddos(spark, sf):
    """Connections / packets per source per tumbling hour."""
    return TH.ddos(C.ended_events(spark, sf), "1 hour", min_connections=2, min_packets=60)


def _slide_sql(target: str, name: str, k: int) -> str:
    b = _bucket("ts", 43200)
    return ENDED_CTE + f""",
w AS (SELECT {b} AS window_start, src_ip, {target} FROM ended
        UNION ALL SELECT {b} - INTERVAL 12 HOUR, src_ip, {target} FROM ended)
SELECT window_start, src_ip, count(DISTINCT {target}) AS {name}, count(*) AS connections
FROM w GROUP BY ALL HAVING count(DISTINCT {target}) >= {k}"""


@register("threat_port_scan", _slide_sql("dst_port", "distinct_ports", 4))
def q_threat_port_scan(spark, sf):
    """Distinct destination ports per source, sliding 1 day / 12 h windows."""
    return TH.port_scan(C.ended_events(spark, sf), "1 day", "12 hours", min_ports=4)


@register("threat_network_scan", _slide_sql("dst_ip", "distinct_hosts", 4))
def q_threat_network_scan(spark, sf):
    """D3: distinct destinations per source, sliding 1 day / 12 h windows."""
    return TH.network_scan(C.ended_events(spark, sf), "1 day", "12 hours", min_hosts=4)


@register("threat_port_scan_sketch", _slide_sql("dst_port", "distinct_ports", 4))
def q_threat_port_scan_sketch(spark, sf):
    """Distinct destination ports from one mergeable sketch per source and pane."""
    return TH.port_scan(C.ended_events(spark, sf), "1 day", "12 hours", min_ports=4, approx=True)


@register("threat_network_scan_sketch", _slide_sql("dst_ip", "distinct_hosts", 4))
def q_threat_network_scan_sketch(spark, sf):
    """D3: distinct destinations from one mergeable sketch per source and pane."""
    return TH.network_scan(C.ended_events(spark, sf), "1 day", "12 hours", min_hosts=4, approx=True)


@register("threat_exfiltration", """
, s AS (SELECT src_ip, CAST(sum(bytes_sent) AS BIGINT) AS bytes_out, CAST(sum(bytes_rcvd) AS BIGINT) AS bytes_in,
               count(*) AS sessions, round(sum(bytes_sent) / (sum(bytes_rcvd) + 1.0), 6) AS out_in_ratio FROM feat GROUP BY src_ip),
t AS (SELECT quantile_cont(CAST(bytes_out AS DOUBLE), 0.9) AS threshold FROM s)
SELECT src_ip, bytes_out, bytes_in, sessions, out_in_ratio, round(threshold, 6) AS threshold FROM s, t
WHERE bytes_out > threshold AND out_in_ratio > 0.5""")
def q_threat_exfiltration(spark, sf):
    """Sources above the 90th percentile of bytes out with out/in ratio > 0.5."""
    return TH.exfiltration(C.timed_sessions(spark, sf), pct=90.0, min_ratio=0.5)


@register("threat_brute_force", f"""
SELECT {_bucket('ts', 86400)} AS window_start, src_ip, dst_port, count(*) AS denies
FROM parsed WHERE action = 'deny' AND dst_port <> 53 AND protocol <> 'ICMP' GROUP BY ALL HAVING count(*) >= 2""")
def q_threat_brute_force(spark, sf):
    """Denied attempts per (day, source, port) on the pre-pairing events."""
    ev = C.filtered_events(spark, sf).withColumn("ts", syslog_timestamp("timestamp", C.FIXTURE_YEAR))
    return TH.brute_force(ev, "1 day", min_denies=2)


@register("threat_beaconing", f"""
, g AS (SELECT src_ip, dst_ip, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY src_ip, dst_ip ORDER BY ts) AS g
        FROM feat WHERE ts IS NOT NULL AND src_ip IS NOT NULL AND dst_ip IS NOT NULL AND {is_private('dst_ip')} = 0),
a AS (SELECT src_ip, dst_ip, count(*) AS connections, count(g) AS k, avg(g) AS m, stddev_pop(g) AS sd FROM g GROUP BY ALL)
SELECT src_ip, dst_ip, connections, round(m, 6) AS mean_gap_s, round(sd, 6) AS std_gap_s, round(sd / m, 6) AS cv
FROM a WHERE k > 0 AND connections >= 2 AND sd / m <= 1.0 AND m <= 2592000""")
def q_threat_beaconing(spark, sf):
    """Regular connections to external destinations (gap coefficient of variation)."""
    return TH.beaconing(C.timed_sessions(spark, sf), min_connections=2, max_cv=1.0, max_mean_gap_s=2592000.0)


@register("threat_vote", SCORED_CTE + """
SELECT session_id, CAST(is_anomaly + is_rare_dst_port + is_night AS INTEGER) AS votes,
       CAST(is_anomaly + is_rare_dst_port + is_night >= 2 AS INTEGER) AS vote_anomaly FROM scored""")
def q_threat_vote(spark, sf):
    """Majority vote over three detectors' flags."""
    s = scored(spark, sf).withColumnRenamed("is_anomaly", "exfil")
    v = TH.vote(s, ["exfil", "is_rare_dst_port", "is_night"], out="vote_anomaly")
    return v.select("session_id", F.col("votes").cast("int"), F.col("vote_anomaly").cast("int"))


# ---------------------------------------------------------------------------
# Sources without an SQL oracle
# ---------------------------------------------------------------------------


# The share of each line that is left, by event id modulo 6: whole; without its time; with a broken
# tag; cut before its flow; two words; cut before its traffic.
@register("parse_rejects", """
, v AS (SELECT CAST(session_id AS BIGINT) % 6 AS k, 1 + has_create AS n FROM flows),
t AS (SELECT k, sum(n) AS n FROM v WHERE k > 0 GROUP BY k)
SELECT CASE k WHEN 1 THEN 'timestamp' WHEN 4 THEN 'timestamp' WHEN 2 THEN 'RT_FLOW' WHEN 3 THEN 'orig flow' ELSE 'pkts(bytes)' END
         AS first_failed_step, sum(n)::BIGINT AS n_lines,
       sum(CASE WHEN k IN (1, 4) THEN n ELSE 0 END)::BIGINT AS fail_timestamp,
       sum(CASE WHEN k IN (2, 4) THEN n ELSE 0 END)::BIGINT AS fail_rt_flow,
       sum(CASE WHEN k IN (3, 4) THEN n ELSE 0 END)::BIGINT AS fail_orig_flow,
       sum(CASE WHEN k = 4 THEN n ELSE 0 END)::BIGINT AS fail_policy_zone,
       sum(CASE WHEN k IN (3, 4, 5) THEN n ELSE 0 END)::BIGINT AS fail_pkts_bytes
FROM t GROUP BY 1""")
def q_parse_rejects(spark, sf):
    """Lines of the log cut so that each diagnostic step fails: rejected lines by
    the first step that fails, with the failures of every step."""
    from ..sources.syslog import reject_diagnostics
    k, v = F.pmod(F.col("ord.sid"), F.lit(6)), F.col("value")
    cut = (F.when(k == 1, F.substring(v, F.lit(16), F.length(v)))
           .when(k == 2, F.replace(v, F.lit("RT_FLOW_SESSION"), F.lit("RT_FLOW_X")))
           .when(k == 3, F.concat(F.regexp_extract(v, "^(.*?: session \\w+)", 1), F.lit(" RT_FLOW")))
           .when(k == 4, F.lit("RT_FLOW: short"))
           .when(k == 5, F.regexp_extract(v, "^(.*?pol untrust SGi \\S+)", 1)).otherwise(v))
    return reject_diagnostics(C.log_lines(spark, sf).select(cut.alias("value")))
