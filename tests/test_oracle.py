"""Every registered query against its oracle SQL (DuckDB) on sf0.001."""

import pytest

import __spark_entry__ as entry
from tidemark.checks.compare import compare, duckdb_connection
from tidemark.checks.oracle_sql import ORACLE
from tidemark.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con(sf_small):
    return duckdb_connection(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    r = compare(spark, con, sf_small, name, QUERIES[name], ORACLE[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "mom_revenue_growth_pct" in df.columns
