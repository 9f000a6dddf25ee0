"""Registered detector queries. LOF and DBSCAN are exact (DuckDB brute-force oracle on
``embeddings``); isolation forest, one-class SVM, autoencoder and PCA are checked by
row counts here and by property tests."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ensemble
from ..operators.detectors import (Autoencoder, DBSCAN, DetectorStage, ForestTable, IsolationForest, KernelOneClassSVM, LocalOutlierFactor, OneClassSVM,
                                   pca_2d)
from ..operators.detectors import descent
from ..operators.detectors.base import fit_threshold
from ..operators.features import fit_scaler
from ..operators.joins import materialize
from ..session import shared_path
from . import catalog as C
from .registry import r6, register

EMB_CTE = """
, emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
d AS (SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.x, b.x) AS dist FROM emb a, emb b)"""

LOF_SQL = EMB_CTE + """,
ex AS (SELECT * FROM (SELECT a, b, dist, row_number() OVER (PARTITION BY a ORDER BY dist, b) AS rn
                      FROM d WHERE a <> b) WHERE rn <= 20),
kd AS (SELECT a AS id, max(dist) AS kdist FROM ex GROUP BY a),
lrd AS (SELECT ex.a AS id, 1.0 / (avg(greatest(kd.kdist, ex.dist)) + 1e-10) AS lrd FROM ex JOIN kd ON kd.id = ex.b GROUP BY ex.a),
lof_train AS (SELECT ex.a AS id, avg(l.lrd) / max(s.lrd) AS lof FROM ex JOIN lrd l ON l.id = ex.b JOIN lrd s ON s.id = ex.a GROUP BY ex.a),
lthr AS (SELECT quantile_cont(lof, 0.95) AS t FROM lof_train),
inc AS (SELECT * FROM (SELECT a, b, dist, row_number() OVER (PARTITION BY a ORDER BY dist, b) AS rn FROM d) WHERE rn <= 20),
q AS (SELECT inc.a AS id, 1.0 / (avg(greatest(kd.kdist, inc.dist)) + 1e-10) AS lrd_q, avg(l.lrd) AS mean_lrd
      FROM inc JOIN kd ON kd.id = inc.b JOIN lrd l ON l.id = inc.b GROUP BY inc.a)
SELECT id AS vec_id, round(mean_lrd / lrd_q, 6) AS lof, CAST(mean_lrd / lrd_q > t AS INTEGER) AS is_anomaly FROM q, lthr"""


def _embeddings(spark, sf):
    return C.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"),
                                                  F.col("embedding").cast("array<double>").alias("features"))


@register("lof_embeddings", LOF_SQL)
def q_lof_embeddings(spark, sf):
    """Exact local outlier factor (k = 20, novelty scoring of the training rows)."""
    e = _embeddings(spark, sf)
    _, s = LocalOutlierFactor(n_neighbors=20, contamination=0.05).fit_transform(e)
    return s.select(F.col("id").alias("vec_id"), r6("anomaly_score", "lof"), F.col("is_anomaly").cast("int"))


DBSCAN_SQL = EMB_CTE + """,
deg AS (SELECT a AS id, count(*) AS degree FROM d WHERE dist <= 1.2 GROUP BY a),
core AS (SELECT id FROM deg WHERE degree >= 10),
reach AS (SELECT DISTINCT d.a AS id FROM d JOIN core ON core.id = d.b WHERE d.dist <= 1.2)
SELECT deg.id AS vec_id, deg.degree, CAST(deg.id IN (SELECT id FROM core) AS INTEGER) AS is_core,
       CAST(deg.id NOT IN (SELECT id FROM reach) AS INTEGER) AS is_noise
FROM deg"""


@register("dbscan_embeddings", DBSCAN_SQL)
def q_dbscan_embeddings(spark, sf):
    """Exact DBSCAN core and noise sets (ε = 1.2, min_samples = 10)."""
    d = DBSCAN(eps=1.2, min_samples=10).fit_predict(_embeddings(spark, sf))
    return d.select(F.col("id").alias("vec_id"), "degree", F.col("is_core").cast("int"),
                    F.col("is_anomaly").cast("int").alias("is_noise"))


DBSCAN_CLUSTERS_SQL = EMB_CTE + """,
core AS (SELECT a AS id FROM d WHERE dist <= 1.2 GROUP BY a HAVING count(*) >= 10),
edge AS (SELECT d.a, d.b FROM d JOIN core x ON x.id = d.a JOIN core y ON y.id = d.b WHERE d.dist <= 1.2),
label AS (SELECT id, min(l) AS label FROM (
            WITH RECURSIVE reach AS (SELECT id, id AS l FROM core
                                     UNION SELECT edge.b, reach.l FROM reach JOIN edge ON edge.a = reach.id)
            SELECT id, l FROM reach) GROUP BY id),
near AS (SELECT d.a AS id, min(label.label) AS label FROM d JOIN label ON label.id = d.b WHERE d.dist <= 1.2 GROUP BY d.a),
every AS (SELECT emb.vec_id AS id, coalesce(label.label, near.label, -1) AS cluster, label.id IS NOT NULL AS is_core
          FROM emb LEFT JOIN label ON label.id = emb.vec_id LEFT JOIN near ON near.id = emb.vec_id)
SELECT cluster, count(*) AS n, sum(is_core::INTEGER)::BIGINT AS n_core FROM every GROUP BY cluster"""


@register("dbscan_clusters", DBSCAN_CLUSTERS_SQL)
def q_dbscan_clusters(spark, sf):
    """Cluster sizes (label = smallest member id; −1 = noise)."""
    d = DBSCAN(eps=1.2, min_samples=10).fit_predict(_embeddings(spark, sf))
    return d.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("is_core").alias("n_core"))


def _session_matrix(spark, sf):
    f = C.features_df(spark, sf)
    return fit_scaler(f).transform(f).select("session_id", "features")


@register("iforest_scores", None)
def q_iforest_scores(spark, sf):
    """Isolation forest scores and flags per session (contamination 0.05)."""
    x = _session_matrix(spark, sf)
    _, s = IsolationForest(contamination=0.05).fit_transform(x)
    return s.select("session_id", r6("anomaly_score"), "is_anomaly")


@register("ocsvm_scores", None)
def q_ocsvm_scores(spark, sf):
    """M5: one-class SVM (random Fourier features) scores and flags per session."""
    x = _session_matrix(spark, sf)
    _, s = OneClassSVM(nu=0.05).fit_transform(x)
    return s.select("session_id", r6("anomaly_score"), "is_anomaly")


@register("autoencoder_scores", None)
def q_autoencoder_scores(spark, sf):
    """Autoencoder reconstruction error and p95 flag per session."""
    x = _session_matrix(spark, sf)
    _, s = Autoencoder(contamination=0.05).fit_transform(x)
    return s.select("session_id", r6("anomaly_score"), "is_anomaly")


@register("pca_2d", None)
def q_pca_2d(spark, sf):
    """M9: centred 2-D PCA projection of the scaled session features."""
    p, _ = pca_2d(_session_matrix(spark, sf), keep=["session_id"])
    return p.select("session_id", r6("pc1"), r6("pc2"))


# Laws that a fitted detector must obey, whatever its random draws.


def _detectors(contamination: float = 0.05) -> dict:
    return {"autoencoder": Autoencoder(contamination=contamination), "isolation_forest": IsolationForest(contamination=contamination),
            "one_class_svm": OneClassSVM(nu=contamination)}


def _planted(spark, sf):
    """The embeddings with every hundredth vector moved far out, each to a place of its own."""
    x = _embeddings(spark, sf)
    far = F.transform("features", lambda v: v * (20.0 + F.pmod(F.col("id"), F.lit(13))))
    return x.withColumn("features", F.when(F.col("id") % 100 == 7, far).otherwise(F.col("features")))


@register("detector_flag_counts", """
SELECT m.model, count(*) AS n, (count(*) - 1 - floor((count(*) - 1) * 0.95))::BIGINT AS n_flagged
FROM embeddings, (VALUES ('autoencoder'), ('isolation_forest'), ('one_class_svm')) AS m(model) GROUP BY m.model""")
def q_detector_flag_counts(spark, sf):
    """Rows flagged at contamination 0.05 are those above the exact 95th percentile."""
    x, out = _embeddings(spark, sf), None
    for name, d in _detectors().items():
        part = d.fit_transform(x)[1].select(F.lit(name).alias("model"), "is_anomaly")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.sum("is_anomaly").cast("long").alias("n_flagged"))


def _planted_first(spark, sf, name: str):
    x = _planted(spark, sf)
    scored = _detectors()[name].fit_transform(x)[1]
    k = x.filter(F.col("id") % 100 == 7).count()
    return scored.orderBy(F.desc("anomaly_score"), "id").limit(k).select(F.col("id").alias("vec_id"), F.col("is_anomaly").cast("int"))


PLANTED_SQL = "SELECT vec_id, 1 AS is_anomaly FROM embeddings WHERE vec_id % 100 = 7"


@register("iforest_planted", PLANTED_SQL)
def q_iforest_planted(spark, sf):
    """M3: vectors moved far out of the embeddings rank first and are flagged."""
    return _planted_first(spark, sf, "isolation_forest")


@register("autoencoder_planted", PLANTED_SQL)
def q_autoencoder_planted(spark, sf):
    """Vectors moved far out of the embeddings are reconstructed worst and flagged."""
    return _planted_first(spark, sf, "autoencoder")


@register("ocsvm_planted", PLANTED_SQL)
def q_ocsvm_planted(spark, sf):
    """M5: vectors moved far out of the embeddings lie farthest outside and are flagged."""
    return _planted_first(spark, sf, "one_class_svm")


@register("pca_variances", """
, p AS (SELECT log_bytes_sent AS x, log_pkts_rcvd AS y FROM feat),
c AS (SELECT var_samp(x) AS a, var_samp(y) AS b, covar_samp(x, y) AS c FROM p)
SELECT round((a + b) / 2 + sqrt(((a - b) / 2) ** 2 + c ** 2), 6) AS var_1,
       round((a + b) / 2 - sqrt(((a - b) / 2) ** 2 + c ** 2), 6) AS var_2,
       0.0::DOUBLE AS covariance,
       round(((a + b) / 2 + sqrt(((a - b) / 2) ** 2 + c ** 2)) / (a + b), 6) AS explained_1 FROM c""")
def q_pca_variances(spark, sf):
    """M9: variances of the principal components of two features are the eigenvalues of their
    covariance matrix, and the components do not covary."""
    from pyspark.ml.feature import VectorAssembler
    f = VectorAssembler(inputCols=["log_bytes_sent", "log_pkts_rcvd"], outputCol="features").transform(
        C.features_df(spark, sf).select("log_bytes_sent", "log_pkts_rcvd"))
    p, ratios = pca_2d(f, keep=[])
    return p.agg(r6(F.var_samp("pc1"), "var_1"), r6(F.var_samp("pc2"), "var_2"),
                 F.abs(r6(F.covar_samp("pc1", "pc2"), "x")).alias("covariance"),
                 F.round(F.lit(ratios[0] if ratios else None).cast("double"), 6).alias("explained_1"))


# The relational forest: every draw is a hash of seed, tree and id or node, so SQL grows the same forest.
FOREST = {"n_trees": 16, "max_samples": 64, "seed": 42}


def _hash_unit(*parts: str) -> str:
    return "(('0x' || substr(md5(" + " || '-' || ".join(parts) + "), 1, 8))::UBIGINT::DOUBLE / 4294967296.0)"


def _forest_ctes() -> str:
    """CTEs fs (vec_id, score): the forest grown on ``emb`` and walked, level by level."""
    t, psi, seed = FOREST["n_trees"], FOREST["max_samples"], f"'{FOREST['seed']}'"
    levels = (psi - 1).bit_length()
    out = [f"fn AS (SELECT count(*) AS n, least(1.0, 4.0 * {psi} * {t} / greatest(count(*), 1)) AS f FROM emb)",
           f"""m0 AS (SELECT tree, 1::BIGINT AS node, x FROM (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY u, vec_id::VARCHAR) AS k FROM (
    SELECT tree, vec_id, x, f, n, {_hash_unit(seed, 'tree', 'vec_id')} AS u FROM emb, fn, range({t}) AS r(tree)
    WHERE {_hash_unit(seed, "'*'", 'vec_id')} < f)
  WHERE u < least(1.0, 4.0 * {psi} / greatest(n, 1)) / f) WHERE k <= {psi})"""]
    for d in range(levels):
        out.append(f"""s{d} AS (SELECT tree, node, b.f AS f, b.lo + {_hash_unit(seed, 'tree', 'node')} * (b.hi - b.lo) AS split FROM (
  SELECT tree, node, arg_min({{'f': f, 'lo': lo, 'hi': hi}}, md5({seed} || '-' || tree || '-' || node || '-' || f)) AS b FROM (
    SELECT tree, node, f, min(v) AS lo, max(v) AS hi FROM (
      SELECT tree, node, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS f FROM m{d}) GROUP BY tree, node, f HAVING max(v) > min(v))
  GROUP BY tree, node))""")
        out.append(f"""m{d + 1} AS (SELECT tree, CASE WHEN split IS NULL THEN node ELSE 2 * node + (x[f + 1] >= split)::INT END AS node, x
  FROM m{d} LEFT JOIN s{d} USING (tree, node))""")
    out.append(f"leaf AS (SELECT tree, node, count(*) AS size FROM m{levels} GROUP BY tree, node)")
    out.append(f"w0 AS (SELECT vec_id, x, tree, 1::BIGINT AS node, 0 AS h FROM emb, range({t}) AS r(tree))")
    for d in range(levels):
        out.append(f"""w{d + 1} AS (SELECT vec_id, x, tree, CASE WHEN split IS NULL THEN node ELSE 2 * node + (x[f + 1] >= split)::INT END AS node,
  h + (split IS NOT NULL)::INT AS h FROM w{d} LEFT JOIN s{d} USING (tree, node))""")

    def c(n: str) -> str:
        return f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1)::DOUBLE / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"
    out.append(f"""fs AS (SELECT vec_id, round(pow(2.0, -avg(h + {c('coalesce(size, 0)')}) / any_value({c(f'least({psi}, n)')})), 9) AS score
  FROM w{levels} LEFT JOIN leaf USING (tree, node), fn GROUP BY vec_id)""")
    return ",\n".join(out)


def _forest(spark, sf):
    """Scores of the embeddings, rounded so that both engines flag the same rows."""
    m = ForestTable(contamination=0.05, **FOREST)._train(_embeddings(spark, sf))
    scored = m.score(_embeddings(spark, sf)).withColumn("anomaly_score", F.round("anomaly_score", 9))
    return m, scored


@register("forest_table_scores", EMB_CTE + ",\n" + _forest_ctes() + """
SELECT vec_id, round(score, 6) AS anomaly_score, (score > (SELECT quantile_cont(score, 0.95) FROM fs))::INTEGER AS is_anomaly FROM fs""")
def q_forest_table_scores(spark, sf):
    """Isolation forest as a relation, grown and scored in the JVM: score and flag of every row."""
    m, scored = _forest(spark, sf)
    scored = materialize(scored)
    m.set_threshold(fit_threshold(scored, "anomaly_score", 95.0))
    return m.flag(scored).select(F.col("id").alias("vec_id"), r6("anomaly_score"), "is_anomaly")


ENSEMBLE_SQL = LOF_SQL[:LOF_SQL.index("SELECT id AS vec_id")].rstrip() + """,
deg AS (SELECT a AS id, count(*) AS degree FROM d WHERE dist <= 1.2 GROUP BY a),
reach AS (SELECT DISTINCT d.a AS id FROM d JOIN deg ON deg.id = d.b AND degree >= 10 WHERE d.dist <= 1.2),
""" + _forest_ctes() + """,
z AS (SELECT q.id AS vec_id, round(mean_lrd / lrd_q, 6) AS lof, (mean_lrd / lrd_q > t)::INTEGER AS f_lof,
             (q.id NOT IN (SELECT id FROM reach))::INTEGER AS f_dbscan, fs.score AS forest,
             (fs.score > (SELECT quantile_cont(score, 0.95) FROM fs))::INTEGER AS f_forest FROM q JOIN fs ON fs.vec_id = q.id, lthr),
r AS (SELECT *, percent_rank() OVER (ORDER BY lof) AS a, percent_rank() OVER (ORDER BY f_dbscan) AS b,
             percent_rank() OVER (ORDER BY forest) AS c FROM z)
SELECT vec_id, f_dbscan AS flag_dbscan, f_forest AS flag_forest, f_lof AS flag_lof, f_dbscan + f_forest + f_lof AS n_votes,
       (f_dbscan + f_forest + f_lof >= 2)::INTEGER AS is_anomaly, round((a + b + c) / 3, 6) AS mean_rank FROM r"""


@register("ensemble_vote", ENSEMBLE_SQL)
def q_ensemble_vote(spark, sf):
    """Majority vote and mean rank of LOF, DBSCAN and the relational forest, by row id."""
    e = _embeddings(spark, sf)
    _, lof = LocalOutlierFactor(n_neighbors=20, contamination=0.05).fit_transform(e)
    m, forest = _forest(spark, sf)
    forest = materialize(forest)
    m.set_threshold(fit_threshold(forest, "anomaly_score", 95.0))
    got = ensemble.vote({"lof": lof.withColumn("anomaly_score", F.round("anomaly_score", 6)), "forest": m.flag(forest),
                         "dbscan": DBSCAN(eps=1.2, min_samples=10).fit_predict(e)})
    return got.withColumnRenamed("id", "vec_id").withColumn("mean_rank", r6("mean_rank"))


ALL_FIVE = ["autoencoder", "dbscan", "isolation_forest", "lof", "one_class_svm"]


@register("train_save_apply", f"""
SELECT m.model, count(*) AS n, 0::BIGINT AS n_changed FROM closed, (VALUES {', '.join(f"('{m}')" for m in ALL_FIVE)}) AS m(model)
WHERE CAST(session_id AS BIGINT) % 8 = 1 AND dur_s > 0 AND has_create = 1 GROUP BY m.model""")
def q_train_save_apply(spark, sf):
    """Every detector trained on one part of the log as an ML pipeline, saved, loaded and
    applied to another part, where it scores every session as the unsaved one does."""
    s = C.sessions_df(spark, sf)
    part = F.col("session_id").cast("long") % 8
    paired = C.flows_df(spark, sf).where("has_create = 1").select("session_id")
    f = C.engineer_features(s.join(paired, "session_id", "left_semi"), C.FIXTURE_YEAR)
    old, new = materialize(f.where(part == 0)), materialize(f.where(part == 1))
    scaler = fit_scaler(old)

    def compared(name: str):
        options = '{"epochs": 10}' if name == "autoencoder" else '{"rounds": 6}' if name == "one_class_svm" else "{}"
        stage = DetectorStage(detector=name, contamination=0.05, idCol="session_id", options=options)
        model = Pipeline(stages=[*scaler.stages, stage]).fit(old)
        path = shared_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        model.write().save(path)
        cols = ["session_id", "anomaly_score", "is_anomaly"]
        again = PipelineModel.load(path).transform(new).select(F.col("session_id").alias("k"), F.col("anomaly_score").alias("s"),
                                                               F.col("is_anomaly").alias("a"))
        both = model.transform(new).select(*cols).join(again, F.col("session_id") == F.col("k"), "full")
        same = F.col("anomaly_score").eqNullSafe(F.col("s")) & F.col("is_anomaly").eqNullSafe(F.col("a"))
        return both.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n"), F.sum((~same).cast("long")).alias("n_changed"))

    # the detectors do not wait for one another: small jobs of one leave most cores to the others
    with ThreadPoolExecutor(len(ALL_FIVE)) as pool:
        return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(spark)(compared), ALL_FIVE))


@register("kernel_svm_certificate", """
SELECT count(*) AS n, (count(*) - 1 - floor((count(*) - 1) * 0.95))::BIGINT AS n_flagged, 1 AS within_gap, 1 AS feasible,
       1 AS planted_first FROM embeddings""")
def q_kernel_svm_certificate(spark, sf):
    """M5: Nyström one-class SVM over embeddings with planted outliers: a duality gap within 1% of the squared norm, a
    mixture of dual points no longer than the unit ball, the ν-property of its flags, and the planted rows in front."""
    x = _planted(spark, sf)
    model, scored = KernelOneClassSVM(nu=0.05).fit_transform(x)
    p = model.params
    far = F.col("id") % 100 == 7
    got = scored.agg(F.count(F.lit(1)).alias("n"), F.sum("is_anomaly").cast("long").alias("n_flagged"),
                     F.min(F.when(far, F.col("anomaly_score"))).alias("least"), F.max(F.when(~far, F.col("anomaly_score"))).alias("most"))
    ok = lambda b: F.lit(int(b))
    return got.select("n", "n_flagged", ok(p["gap"] <= 0.01 * p["norm2"]).alias("within_gap"), ok(0 < p["norm2"] <= 1).alias("feasible"),
                      (F.col("least") > F.col("most")).cast("int").alias("planted_first"))


@register("descent_recall", "SELECT count(*) AS n, 1 AS all_rows, 1 AS recall_reached FROM embeddings WHERE vec_id % 20 = 0")
def q_descent_recall(spark, sf):
    """Approximate neighbours by neighbour descent over all embeddings; for every twentieth row the exact 20
    nearest are found with a recall of at least 0.9 (a law)."""
    x = materialize(_embeddings(spark, sf).select("id", F.col("features").alias("x")))
    got = materialize(descent.descent_knn(x, 20))
    asked = x.where(F.col("id") % 20 == 0)
    r = descent.recall(got, x, asked, 20)
    whole = got.where(F.size("nbrs") > 0).count() == x.count()
    return asked.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(int(whole)).alias("all_rows"), F.lit(int(r >= 0.9)).alias("recall_reached"))
