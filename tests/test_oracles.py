"""Every query with an SQL form against DuckDB on the same files."""

import importlib.util
from pathlib import Path

import pytest
from compare import TESTDATA, difference, duckdb_over

from registry.oracles import ORACLES
from registry.queries import QUERIES

ENTRY = Path(__file__).resolve().parents[1] / "__spark_entry__.py"
SMALL = str(TESTDATA / "sf0.001")


def load_entry():
    module = importlib.util.module_from_spec(spec := importlib.util.spec_from_file_location("entry", ENTRY))
    spec.loader.exec_module(module)
    return module


entry = load_entry()


@pytest.fixture(scope="module")
def connection():
    return duckdb_over(SMALL)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, connection, name):
    assert difference(entry.queries()[name](spark, SMALL), connection, entry.oracle_sql()[name]) is None


def test_every_query_has_sql_or_a_test():
    # Models over a label that their inputs explain in part: test_train.py counts the pairs of its leader.
    assert set(QUERIES) - set(ORACLES) == {"train_leaderboard"}


def test_entry_has_a_row_per_user(spark):
    df = entry.entry(spark)
    assert df.count() == spark.read.parquet(f"{SMALL}/events.parquet").select("user_id").distinct().count()
    assert len(df.columns) == 2 + 3 * 5 * 5
