"""Every SQL-expressible registered query equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from tillcast.plans.compare import compare, duckdb_connection
from tillcast.plans.oracle_sql import oracle_sql

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duckdb_connection(sf_small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_small, con, name):
    df = E.queries()[name](spark, sf_small)
    r = compare(df, con, ORACLES[name])
    assert r["columns_match"], (r["spark_columns"], r["oracle_columns"])
    assert r["types_match"], r["type_pairs"]
    assert r["values_match"], (r["rows"], r["only_spark"], r["only_oracle"])
