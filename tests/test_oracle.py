"""Every registered query against its SQL on the test tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from tradelake import queries as registry

QUERIES = registry.queries()
SQL = registry.comparison_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, folder, con, name):
    assert compare(QUERIES[name](spark, folder), con, SQL[name]) is None
