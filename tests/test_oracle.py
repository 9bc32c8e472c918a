"""Every registered query against its DuckDB twin on the smallest table set."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.checks.compare import compare, register_tables
from ledgerline.sources.fixture import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    register_tables(c, SF, TABLES)
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(E.QUERIES)))
def test_query_matches_sql_twin(spark, con, name):
    out = compare(name, E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    assert out.ok, out.detail


def test_every_query_has_twin_or_is_listed():
    assert set(E.QUERIES) - set(E.oracle_sql()) == set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["category", "total_revenue", "total_profit", "total_orders"]
    assert df.count() > 0
