"""DBSCAN, exact: degrees by range searches over pivot partitions, core = |N_ε| ≥
min_samples (self included), clusters = connected components of the links that span
core vectors block by block (minimum-label propagation with pointer jumping, run to
convergence; inside cells first, then between what is still apart), border points take the smallest label among their core neighbours, the
rest is noise (label −1 → anomaly). The cluster label is the smallest core member id.
Transductive like the original: it labels the rows it was fitted on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...schema import DBSCAN_EPS, DBSCAN_MIN_SAMPLES
from ..joins import materialize
from .base import DetectorModel, as_array
from .neighbors import RangeIndex


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(id, label): each label becomes the least of those that the links (a, b) connect it with."""
    links = materialize(links.distinct())
    if links.isEmpty():
        return labels
    both = materialize(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    least = materialize(both.select(F.col("a").alias("id")).distinct().withColumn("label", F.col("id")))
    while True:  # to convergence: pointer jumping makes rounds logarithmic in a chain's length
        nb = both.join(least.select(F.col("id").alias("b"), F.col("label").alias("lb")), "b") \
            .groupBy(F.col("a").alias("id")).agg(F.min("lb").alias("lb"))
        new = materialize(least.join(nb, "id", "left").select("id", F.least("label", F.coalesce("lb", "label")).alias("label")))
        up = new.select(F.col("id").alias("label"), F.col("label").alias("up"))
        new = materialize(new.join(up, "label").select("id", F.col("up").alias("label")))
        changed = not new.join(least.select("id", F.col("label").alias("old")), "id").where("label <> old").isEmpty()
        least = new
        if not changed:
            break
    least = least.select(F.col("id").alias("label"), F.col("label").alias("least"))
    return materialize(labels.join(least, "label", "left").select("id", F.coalesce("least", "label").alias("label")))


class DBSCAN:
    def __init__(self, eps: float = DBSCAN_EPS, min_samples: int = DBSCAN_MIN_SAMPLES,
                 features_col: str = "features", id_col: str = "id"):
        self.eps, self.min_samples, self.features_col, self.id_col = eps, min_samples, features_col, id_col

    def fit_predict(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` + degree, is_core, cluster (−1 noise), is_anomaly, anomaly_score."""
        pts = df.select(F.col(self.id_col).cast("bigint").alias("id"), as_array(df, self.features_col).alias("x"))
        index = RangeIndex(pts, self.eps)
        if index.points is None:
            return df.select("*", *(F.lit(0).cast(t).alias(n) for n, t in (
                ("degree", "long"), ("is_core", "int"), ("cluster", "long"), ("is_anomaly", "int"), ("anomaly_score", "double"))))
        deg = materialize(index.degrees())
        core = deg.where(F.col("degree") >= self.min_samples).select("id")
        labels = materialize(core.select("id", F.col("id").alias("label")))
        # inside cells, then from a few rows to all cells: what these join has no more links to be looked for
        labels = _joined(labels, index.links(labels, own_cell=True))
        labels = _joined(labels, index.links(labels, asked=F.pmod(F.xxhash64("id"), F.lit(64)) == 0))
        labels = _joined(labels, index.links(labels))
        rest = deg.where(F.col("degree") < self.min_samples).select("id")
        border = index.least_label(rest, labels).select("id", F.col("label").alias("border_label"))
        out = index.points.select("id", "vh").join(deg, "id").join(labels, "id", "left").join(border, "id", "left")
        out = out.select("vh", F.col("degree"), F.col("label").isNotNull().cast("int").alias("is_core"),
                         F.coalesce("label", "border_label", F.lit(-1)).alias("cluster"))
        out = out.withColumn("is_anomaly", (F.col("cluster") == -1).cast("int")) \
                 .withColumn("anomaly_score", F.col("is_anomaly").cast("double"))
        by_row = index.rows.select(F.col("id").alias("__id"), "vh").join(materialize(out), "vh").drop("vh")
        return df.join(by_row, F.col(self.id_col).cast("bigint") == F.col("__id")).drop("__id")

    def fit(self, df: DataFrame) -> "DBSCANModel":
        """The model is its parameters: clusters belong to the rows they are found in."""
        return DBSCANModel({"eps": self.eps, "min_samples": self.min_samples, "id_col": self.id_col}, None, self.features_col)


class DBSCANModel(DetectorModel):
    """Saved DBSCAN parameters; ``transform`` clusters the rows it is given."""

    name = "dbscan"

    def transform(self, df: DataFrame) -> DataFrame:
        p = self.params
        return DBSCAN(p["eps"], p["min_samples"], self.features_col, p["id_col"]).fit_predict(df)

    @classmethod
    def load(cls, spark, path: str) -> "DBSCANModel":
        meta = DetectorModel.read_meta(spark, path)
        return cls(meta["params"], meta["threshold"], meta["features_col"])
