"""Every query with SQL gives the SQL's rows on the smallest tables; every other one runs."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare

SQL = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf, name):
    assert compare(spark, sf, entry.queries()[name], SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_runs(spark, sf, name):
    df = entry.queries()[name](spark, sf)
    assert df.count() >= 0 and df.columns


def test_entry(spark):
    assert entry.entry(spark).count() > 0
