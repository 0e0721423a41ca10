"""Every registered query against its SQL at sf0.01."""

import pytest

import __spark_entry__ as entry
from oracle import connect, duck_rows, spark_rows

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    columns, rows = spark_rows(entry.queries()[name](spark, FOLDER))
    expected_columns, expected = duck_rows(con, entry.oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
