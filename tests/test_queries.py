import os

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_every_query_has_its_check():
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, database, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert difference(result, database, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
