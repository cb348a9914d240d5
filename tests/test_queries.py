"""Every registered query that has SQL must give the same values on another engine."""

import pytest

import __spark_entry__ as e
from compare import differences, duck

SF = "/root/testdata/sf0.001"
QUERIES, SQL = e.queries(), e.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(SQL) - {"cv_coverage"}))
def test_same_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, SQL[name]) == ""


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert e.entry(spark).count() > 0
