"""Every registered query against its SQL, on the smallest data."""

import os

import pytest

import __spark_entry__ as contract
from carelake.plans import oracle, registry
from check_oracle import compare, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not there")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_query_equals_sql(spark, con, key):
    assert compare(spark, con, SF_DIR, key, contract.oracle_sql()[key]) == ""


def test_entry_has_rows_and_a_schema(spark):
    found = contract.entry(spark)
    assert found.columns == ["patient", "allergyLabel", "drugLabel", "family"] and found.count() > 0
