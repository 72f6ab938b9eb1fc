"""Every query with an SQL twin must agree with it; the others must give rows."""

import pytest

import __spark_entry__ as entry_mod
from tests.oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_mod.queries(), entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_sql(spark, con, key):
    assert compare(QUERIES[key](spark, SF_DIR), con, ORACLES[key]) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, key):
    df = QUERIES[key](spark, SF_DIR)
    assert df.columns and df.count() > 0


def test_entry(spark):
    assert entry_mod.entry(spark).count() == 1
