"""Every query with an SQL twin gives the same rows as DuckDB on the small tables."""

import os

import pytest
from oracle import compare, duck

import __spark_entry__ as entry

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    problem, _, _ = compare(spark, con, SF, entry.queries()[name], ORACLES[name])
    if problem == "no rows":
        pytest.skip("no rows at this scale, and none expected")
    assert problem is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0
