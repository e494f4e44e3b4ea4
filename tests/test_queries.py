"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, difference

from larkspur.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
