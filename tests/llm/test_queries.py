"""Corpus queries with an SQL form against DuckDB on the same files."""

import pytest
from compare import difference, duckdb_over

from cohortloom.llm.oracles import ORACLES
from cohortloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duckdb_over(SMALL)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SMALL), connection, ORACLES[name]) is None
