"""Every query at the smallest scale, against its SQL twin where it has one."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, oracle, sql) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
