"""Every query of the library with oracle SQL, against DuckDB, on the smallest tables (those of
the training-data operators: ``tests/llm/test_oracles.py``)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from netsift.plans.all_queries import REGISTRY  # noqa: E402
from tools.oracle_check import compare, duck  # noqa: E402

SF = os.environ.get("NETSIFT_ORACLE_SF", "/root/testdata/sf0.001")
SQL = {n: q.sql for n, q in REGISTRY.items() if q.sql is not None}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sp = REGISTRY[name].build(spark, SF).toPandas()
    dk = con.execute(SQL[name]).df()
    ok, msg = compare(sp, dk)
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "src_ip" in df.columns
