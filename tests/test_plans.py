"""Plan-shape checks: the physical plans keep the properties the design relies on."""

import os

from pyspark.sql import functions as F

from netsift.operators import profile as P
from netsift.operators.features import engineer_features
from netsift.plans import catalog as C
from netsift.sources.syslog import parse_lines

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_regex_runs_once_per_line(spark):
    plan = _plan(parse_lines(C.log_lines(spark, SF).select("value")))
    assert plan.count("regexp_replace") == 1


def test_feature_lookups_are_broadcast_not_shuffled(spark, scratch):
    path = os.path.join(scratch, "sess")
    C.sessions_df(spark, SF).write.parquet(path)
    f = engineer_features(spark.read.parquet(path), C.FIXTURE_YEAR, materialize_input=False)
    plan = _plan(f)
    assert plan.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in plan


def test_top_k_reads_one_column_per_branch(spark, scratch):
    path = os.path.join(scratch, "sess")
    C.sessions_df(spark, SF).write.parquet(path)
    plan = _plan(P.top_values(spark.read.parquet(path)))
    assert plan.count("TakeOrderedAndProject") == 4
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert all(ln.split("[", 1)[1].split("]", 1)[0].count(",") == 0 for ln in scans)


def test_exact_quantile_has_no_single_partition_value_map(spark, monkeypatch):
    from netsift.operators import quantiles
    ranged = []
    keep = quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df: ranged.append(keep(df)) or ranged[-1])
    df = C.table(spark, SF, "lineitem")
    q = quantiles.exact_quantiles(df, "l_extendedprice", [0.5])
    assert "percentile(" not in _plan(q)
    # totals and ranks read one checkpointed table, cut into ranges that do not overlap
    assert _plan(q).count("Scan ExistingRDD") == 2 and len(ranged) == 1
    parts = ranged[0].groupBy("pid").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("lo").collect()
    assert len(parts) > 1 and all(x.hi < y.lo for x, y in zip(parts, parts[1:]))


def test_correlation_covers_every_numeric_column(spark):
    from netsift.operators.profile import numeric_columns
    from netsift.plans.q_analysis import CORR_COLUMNS
    assert set(numeric_columns(C.features_df(spark, SF))) == set(CORR_COLUMNS)
