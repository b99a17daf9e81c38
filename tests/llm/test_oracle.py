"""The operators that SQL can express equal DuckDB on the test tables."""

import pytest

from tillcast.llm import queries
from tillcast.plans.compare import compare, duckdb_connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_oracle(spark, sf_small, name):
    r = compare(queries.QUERIES[name](spark, sf_small), duckdb_connection(sf_small), queries.ORACLE_SQL[name])
    assert r["columns_match"] and r["types_match"] and r["values_match"], r
