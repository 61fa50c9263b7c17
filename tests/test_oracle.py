"""Every registered query against its SQL twin on the smallest test data."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from tillcast import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", registry.queries())
def test_query_equals_its_sql_twin(spark, connection, name):
    df = registry.queries()[name](spark, FOLDER)
    assert differences(df, connection, registry.oracle_sql()[name]) == []


def test_every_query_has_a_twin():
    assert registry.queries().keys() == registry.oracle_sql().keys()
    assert contract.queries().keys() >= registry.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
