"""Every registered query with SQL of its own gives the same rows on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

DATA = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    said, _ = compare(spark, con, DATA, name, entry.queries()[name], SQL[name])
    assert said.startswith("ok"), said


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
