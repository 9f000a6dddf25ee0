import random

import pytest
from llm_brute import words

SF_SMALL = "/root/testdata/sf0.001"  # as in tests/conftest.py, whose module name this file takes in a whole run
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, lh string, fp long, n string"


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and long texts, repeated rows, copies, odd characters."""
    rng = random.Random(3)
    body = words(rng, 80)
    texts = [None, "", " \t\n ", "?!", "é", body, body, body.replace(" ", "  ", 3), body + "\n" + body,
             words(rng, 40000), "\n".join(words(rng, 12) for _ in range(50)), "x" * 300000, "Ünïcödé 文字 " * 40,
             "a\x01b\x02c", "line\r\nline\r\n"]
    rows = [(i, t, "en", "s1", None if t is None else len(t), "7", "x", 1, "y") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, body, None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None), (99, "short words here", None, None, 16, None, None, 5, "q")]
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
