"""Registered queries against their DuckDB SQL on the smallest tables."""

import pytest

from netsift.llm.queries import BUILDERS, SQL
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    ok, why = compare(BUILDERS[name](spark, SF).toPandas(), duck(SF).execute(SQL[name]).df())
    assert ok, why


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in BUILDERS) == list(range(1, 14))
