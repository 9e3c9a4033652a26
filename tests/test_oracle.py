"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry
from siltstone.plans import oracle, registered
from tests.oracle_check import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(registered.queries()))
def test_rows_equal_the_sql(spark, con, name):
    assert differences(spark, con, SF_DIR, name) == []


def test_every_query_has_a_twin():
    assert set(registered.queries()) == set(oracle.oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0
