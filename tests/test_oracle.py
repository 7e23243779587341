"""Every registered query against its SQL, or for non-empty rows."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, sf, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], sf) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_only_for_registered_queries():
    assert set(ORACLES) <= set(QUERIES)
