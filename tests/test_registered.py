"""Every registered query with an SQL twin gives the same rows."""

import pytest
from oracle import connect, difference

import __spark_entry__ as registered

SF = "/root/testdata/sf0.001"
TWINS = registered.oracle_sql()


def test_twins_belong_to_queries():
    assert set(TWINS) <= set(registered.queries())


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["i", "j", "w"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(TWINS))
def test_same_rows(spark, name):
    got = registered.queries()[name](spark, SF).toPandas()
    assert difference(got, connect(SF).execute(TWINS[name]).df()) is None
