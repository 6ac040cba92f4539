"""Every registered query against its SQL twin on the smallest data folder."""

import pytest

import __spark_entry__ as entry
from corpus_ledger.plans import ORACLES as PLAN_ORACLES
from corpus_ledger.plans import QUERIES
from tests.compare import difference, oracle_connection

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(PLAN_ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doi"]
    assert df.count() > 0
