"""Every registered query against its SQL, on whole tables."""

import os

import pytest
from compare import oracle_connection, oracle_side, spark_side

from starmart.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def oracle():
    con = oracle_connection(SF_DIR)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    types, rows = spark_side(QUERIES[name](spark, SF_DIR))
    expected_types, expected = oracle_side(oracle, ORACLES[name])
    assert list(types) == list(expected_types)
    assert rows, "a query without rows checks nothing"
    assert rows == expected
    assert types == expected_types
