"""Every registered query equals its DuckDB oracle SQL (sf0.001)."""

import pytest

import __spark_entry__ as E
import oracle_sql
from conftest import SF001
from martforge import catalog
from oracle_compare import compare, duck

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(oracle_sql.ORACLE)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(oracle_sql.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SF001, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["category", "total_sales", "total_quantity", "sales_share"]
