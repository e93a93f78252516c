"""Every registered query against its SQL on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest

from helpers import TESTDATA

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import TABLES, normal  # noqa: E402
from tideline import queries as registered  # noqa: E402

# The queries for training data, where installed, are tested in tests/llm.
QUERIES = registered.QUERIES
STATEMENTS = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}
# Queries without SQL; tests/test_risk.py checks what they compute.
MODELS = {"glm_scores", "gbt_scores"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{name}.parquet'")
    return con


def test_every_query_has_sql_unless_it_trains_a_model():
    assert set(QUERIES) - set(STATEMENTS) == MODELS
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_a_missing_library_of_the_training_queries_leaves_the_rest():
    code = ("import sys; sys.modules['xxhash'] = None; import warnings; warnings.simplefilter('ignore'); "
            "import __spark_entry__ as entry; print(sorted(entry.queries()), sorted(entry.oracle_sql()))")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=100)
    assert out.stdout.strip() == f"{sorted(QUERIES)} {sorted(STATEMENTS)}", out.stderr[-500:]


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, TESTDATA)
    found = duck.execute(STATEMENTS[name])
    expected = normal([c[0] for c in found.description], found.fetchall())
    got = normal(df.columns, df.collect())
    assert list(got.columns) == list(expected.columns)
    assert got.equals(expected)
