"""Every registered query against its SQL oracle (sf0.001, DuckDB)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tools.compare import compare, duckdb_connection

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duckdb_connection(sf_small)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, sf_small, name):
    got = QUERIES[name](spark, sf_small).toPandas()
    want = con.execute(ORACLE[name]).df()
    status, detail = compare(got, want)
    assert status == "OK", detail


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    assert df.columns
    assert df.count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["InvoiceDate", "DailyOrderCount", "DailySalesAmount", "DailyTotalQuantity"]
    assert df.count() == 987
