"""Every registered query against its SQL, on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry_point

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert compare.difference(df, connection, ORACLES[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
