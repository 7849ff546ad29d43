"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as contract
from hitflow.plans.queries import QUERIES
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert name in contract.oracle_sql()
    df = contract.queries()[name](spark, SF_DIR)
    assert difference(df, con, contract.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
