"""Every query against its SQL in another engine, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.compare import connect, differences
from tillstream.plans import catalog, oracles

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), oracles.SQL


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    rows, found = differences(spark, con, SF_DIR, QUERIES[name], SQL[name])
    assert rows > 0
    assert found == []


def test_entry(spark):
    assert contract.entry(spark).columns == ["transaction_date", "total_sales"]


def test_every_query_is_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())
