"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from check_oracles import compare, connect, entry

from filestrata.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, name, SF_DIR) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
