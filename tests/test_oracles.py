"""Every registered query against its SQL counterpart."""

import pytest
from check import compare, connect

import __spark_entry__ as entry_point
from txnflow.plans import oracles, queries

SF = "/root/testdata/sf0.001"
QUERIES = queries.registered()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    count, difference = compare(spark, con, QUERIES[name], ORACLES[name], SF)
    assert difference is None
    assert count > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
