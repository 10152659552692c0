"""Queries that SQL can express, against it, on whole tables."""

import os

import pytest
from compare import oracle_connection, oracle_side, spark_side

from starmart.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def oracle():
    con = oracle_connection(SF_DIR)
    yield con
    con.close()


def test_a_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, oracle, name):
    types, rows = spark_side(QUERIES[name](spark, SF_DIR))
    expected_types, expected = oracle_side(oracle, ORACLES[name])
    assert rows == expected
    assert types == expected_types
