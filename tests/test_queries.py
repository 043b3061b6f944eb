"""Every registered query against its SQL twin, on the whole tables of the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
from check_oracle import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_sql(spark, name):
    ok, note = compare(spark, SF_DIR, name)
    assert ok, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
