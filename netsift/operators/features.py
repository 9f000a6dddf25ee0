"""Per-session feature engineering and the standardised model matrix.

All row-level features are built-in expressions inside one projection. Three
features need data-wide context and are computed as small aggregates joined back:

* rare destination port — per-port counts (≤ distinct ports) and their 10 % quantile;
* per-source behaviour — rows, distinct ports, distinct destinations per ``src_ip``
  (partial aggregation first, so a source holding a third of the rows is collapsed
  map-side);
* protocol code — the index of the protocol name among the sorted distinct names.

Each lookup is an aggregate of the written sessions, is checkpointed itself, and is
broadcast only after its bytes are checked (``joins.attach_lookup``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.net import is_high_port, is_private_ip, is_privileged_port, is_well_known_port
from ..functions.numeric import as_flag, log1p0, safe_div
from ..functions.timefn import any_timestamp, is_night
from ..schema import FEATURE_COLUMNS, LOG_COLUMNS
from .joins import attach_lookup, attach_scalars, materialize, stage

_NUMERIC = {"src_port": "int", "dst_port": "int", "bytes_sent": "bigint", "bytes_rcvd": "bigint",
            "pkts_sent": "bigint", "pkts_rcvd": "bigint", "duration": "double", "protocol_num": "int"}

RARE_PORT_QUANTILE = 0.10


def _coerce(df: DataFrame) -> DataFrame:
    """Numeric coercion: unparsable / NULL / out of range → 0 for the eight traffic columns."""
    out = []
    for f in df.schema.fields:
        if f.name in _NUMERIC:
            typ = _NUMERIC[f.name]
            c = F.col(f.name)
            if isinstance(f.dataType, T.StringType):
                c = c.try_cast("double")
            out.append(F.coalesce(c.try_cast(typ), F.lit(0).cast(typ)).alias(f.name))
        else:
            out.append(F.col(f.name))
    df = df.select(*out)
    if "duration" not in df.columns:
        df = df.withColumn("duration", F.lit(0.0))
    return df


def port_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("dst_port").agg(F.count(F.lit(1)).alias("_port_n"))


def rare_port_threshold(counts: DataFrame, q: float = RARE_PORT_QUANTILE) -> DataFrame:
    """Linear-interpolated quantile of the per-port counts (over ports, not rows)."""
    return counts.agg(F.percentile(F.col("_port_n").cast("double"), q).alias("_rare_q"))


def source_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per source: rows with a destination port, distinct destination ports and IPs."""
    dc = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    return (df.where(F.col("src_ip").isNotNull())
            .groupBy("src_ip")
            .agg(F.count("dst_port").alias("src_connection_count"),
                 dc("dst_port").alias("src_unique_dst_ports"),
                 dc("dst_ip").alias("src_unique_dst_ips")))


def protocol_index(df: DataFrame) -> DataFrame:
    """Sorted distinct protocol names (NULL as 'UNKNOWN') → 0-based code.

    The distinct table is tiny (one row per protocol name), so ranking it in a single
    window partition is bounded.
    """
    names = df.select(F.coalesce(F.col("protocol"), F.lit("UNKNOWN")).alias("_proto")).distinct()
    return names.withColumn("protocol_enc", (F.dense_rank().over(Window.orderBy("_proto")) - 1).cast("int"))


class FeatureLookups:
    """Data-wide lookups fitted once on training sessions and reused for new data:
    per-port session counts, the rare-port threshold, the protocol index.

    (Per-source behaviour counts stay per dataset by design.) Saved as parquet + a
    one-row threshold table, so scoring a new log uses the training definitions.
    """

    def __init__(self, ports: DataFrame, rare_threshold: float | None, protocols: DataFrame):
        self.ports, self.rare_threshold, self.protocols = ports, rare_threshold, protocols

    @classmethod
    def fit(cls, sessions: DataFrame) -> "FeatureLookups":
        df = _coerce(sessions)
        ports = materialize(port_counts(df))
        thr = rare_port_threshold(ports).first()[0]
        protos = materialize(protocol_index(df.withColumn("protocol", F.col("protocol"))))
        return cls(ports, thr, protos)

    def save(self, path: str) -> str:
        import os
        self.ports.write.mode("overwrite").parquet(os.path.join(path, "ports"))
        self.protocols.write.mode("overwrite").parquet(os.path.join(path, "protocols"))
        spark = self.ports.sparkSession
        spark.createDataFrame([(self.rare_threshold,)], "rare_threshold double").write.mode("overwrite") \
            .parquet(os.path.join(path, "threshold"))
        return path

    @classmethod
    def load(cls, spark, path: str) -> "FeatureLookups":
        import os
        thr = spark.read.parquet(os.path.join(path, "threshold")).first()[0]
        return cls(spark.read.parquet(os.path.join(path, "ports")), thr,
                   spark.read.parquet(os.path.join(path, "protocols")))


def engineer_features(sessions: DataFrame, year: int, approx_distinct: bool = False,
                      materialize_input: bool = True, lookups: FeatureLookups | None = None) -> DataFrame:
    """Closed sessions → sessions plus all engineered columns (see ``schema.FEATURE_COLUMNS``).

    With ``materialize_input`` the sessions are written once as a stage (shared folder), so the
    three lookup aggregates and the main projection read the columns they need from it instead
    of re-running parsing and pairing.
    """
    if materialize_input:
        sessions = stage(sessions, "sessions")
    df = _coerce(sessions)
    base_rows = df  # the lookups are aggregates of the rows before any lookup is joined
    bs, br = F.coalesce(F.col("bytes_sent"), F.lit(0)), F.coalesce(F.col("bytes_rcvd"), F.lit(0))
    ps, pr = F.coalesce(F.col("pkts_sent"), F.lit(0)), F.coalesce(F.col("pkts_rcvd"), F.lit(0))
    dur = F.coalesce(F.col("duration"), F.lit(0.0))
    df = (df.withColumn("bytes_total", (bs + br).cast("bigint"))
          .withColumn("pkts_total", (ps + pr).cast("bigint"))
          .withColumn("bytes_ratio", safe_div("bytes_sent", F.col("bytes_rcvd") + 1))
          .withColumn("pkts_ratio", safe_div("pkts_sent", F.col("pkts_rcvd") + 1))
          .withColumn("bytes_per_sec", safe_div("bytes_total", dur + 1))
          .withColumn("pkts_per_sec", safe_div("pkts_total", dur + 1))
          .withColumn("avg_pkt_size", safe_div("bytes_total", F.col("pkts_total") + 1))
          .withColumn("is_well_known_port", is_well_known_port("dst_port"))
          .withColumn("is_high_port", is_high_port("dst_port"))
          .withColumn("is_privileged_port", is_privileged_port("dst_port")))

    # rare destination port: per-port count vs the 10 % quantile of counts
    if lookups is None:
        counts = materialize(port_counts(base_rows))  # read for the quantile and for the join
        df = attach_lookup(df, counts, "dst_port", stored=True)
        df = attach_scalars(df, rare_port_threshold(counts))
    else:  # training definitions; an unseen port counts 0
        df = attach_lookup(df, lookups.ports, "dst_port")
        df = df.withColumn("_rare_q", F.lit(lookups.rare_threshold).cast("double"))
    df = df.withColumn("is_rare_dst_port", as_flag(F.coalesce(F.col("_port_n"), F.lit(0)) <= F.col("_rare_q")))

    sp, dp = is_private_ip("src_ip"), is_private_ip("dst_ip")
    df = (df.withColumn("src_is_private", sp).withColumn("dst_is_private", dp)
          .withColumn("is_outbound", ((F.col("src_is_private") == 1) & (F.col("dst_is_private") == 0)).cast("int"))
          .withColumn("is_inbound", ((F.col("src_is_private") == 0) & (F.col("dst_is_private") == 1)).cast("int"))
          .withColumn("is_internal", ((F.col("src_is_private") == 1) & (F.col("dst_is_private") == 1)).cast("int")))

    df = attach_lookup(df, source_stats(base_rows, approx_distinct), "src_ip")

    df = df.withColumn("_proto", F.coalesce(F.col("protocol"), F.lit("UNKNOWN")))
    if lookups is None:
        df = attach_lookup(df, protocol_index(base_rows), "_proto")
    else:  # an unseen protocol gets the next free code
        known = lookups.protocols.agg(F.count(F.lit(1)).cast("int").alias("_n_known"))
        df = attach_lookup(df, lookups.protocols, "_proto")
        df = attach_scalars(df, known).withColumn(
            "protocol_enc", F.coalesce(F.col("protocol_enc"), F.col("_n_known"))).drop("_n_known")
    df = df.withColumn("is_denied", as_flag(F.lower(F.col("action")) == "deny") if "action" in df.columns
                       else F.lit(0))

    if "timestamp" in df.columns:
        ts_type = df.schema["timestamp"].dataType
        ts = F.col("timestamp") if isinstance(ts_type, (T.TimestampType, T.TimestampNTZType)) \
            else any_timestamp(F.col("timestamp"), year)
        df = (df.withColumn("timestamp", ts.cast("timestamp_ntz"))
              .withColumn("hour", F.hour("timestamp"))
              .withColumn("day_of_week", F.weekday("timestamp"))
              .withColumn("is_night", is_night("hour")))
    else:
        df = df.withColumn("hour", F.lit(12)).withColumn("day_of_week", F.lit(0)).withColumn("is_night", F.lit(0))

    for c in LOG_COLUMNS:
        if c in df.columns:
            df = df.withColumn(f"log_{c}", log1p0(c))
    base = [c for c in sessions.columns if c not in ("duration",)] + ["duration"]
    base = [c for c in base if c in df.columns]
    new = ["bytes_total", "pkts_total", "bytes_ratio", "pkts_ratio", "bytes_per_sec", "pkts_per_sec",
           "avg_pkt_size", "is_well_known_port", "is_high_port", "is_privileged_port", "is_rare_dst_port",
           "src_is_private", "dst_is_private", "is_outbound", "is_inbound", "is_internal",
           "src_connection_count", "src_unique_dst_ports", "src_unique_dst_ips", "protocol_enc",
           "is_denied", "hour", "day_of_week", "is_night"] + [f"log_{c}" for c in LOG_COLUMNS if c in df.columns]
    return df.select(*base, *[c for c in new if c not in base])


def feature_columns(df: DataFrame) -> list[str]:
    """The model columns present in ``df``, in model order."""
    return [c for c in FEATURE_COLUMNS if c in df.columns]


def _clean_expr(c: str) -> str:
    x = f"CAST(`{c}` AS DOUBLE)"
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) OR abs({x}) = double('Infinity') "
            f"THEN 0.0 ELSE {x} END")


def fit_scaler(df: DataFrame, names: list[str] | None = None, output_col: str = "features",
               keep_columns: bool = True) -> PipelineModel:
    """Fit the standardiser: zero mean, unit **population** variance per column.

    One aggregate pass computes mean and population std of the cleaned columns
    (NULL/NaN/±inf → 0); a zero-variance column scales by 1 (→ all zeros). The fitted
    constants live in a ``SQLTransformer`` stage, followed by a ``VectorAssembler``;
    the result is a persistable ``PipelineModel``. A column is constant if its least value is
    its largest: the merged variance of equal values may be a rounding error above zero.
    """
    names = names or feature_columns(df)
    cleaned = [F.expr(_clean_expr(c)).alias(c) for c in names]
    stats = df.select(*cleaned).agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
                                    *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(names)],
                                    *[(F.min(c) == F.max(c)).alias(f"c{i}") for i, c in enumerate(names)]).first()
    exprs = []
    for i, c in enumerate(names):
        m = stats[f"m{i}"] or 0.0
        s = stats[f"s{i}"] or 0.0
        s = s if s > 0 and not stats[f"c{i}"] else 1.0
        exprs.append(f"(({_clean_expr(c)}) - ({m!r})) / ({s!r}) AS `z_{c}`")
    select = "SELECT *, " + ", ".join(exprs) + " FROM __THIS__"
    sql = SQLTransformer(statement=select)
    asm = VectorAssembler(inputCols=[f"z_{c}" for c in names], outputCol=output_col)
    model = Pipeline(stages=[sql, asm]).fit(df.limit(0))
    return model


def scaled_columns(model: PipelineModel) -> list[str]:
    return list(model.stages[1].getInputCols())


def feature_matrix(df: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Rows + standardised ``z_<feature>`` columns + ``features`` vector."""
    model = model or fit_scaler(df)
    return model.transform(df)
