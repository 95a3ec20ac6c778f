"""Every registered query against its SQL on DuckDB, on the smallest data."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from strataflow.registry import load_all
from tests.oracle import compare, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = load_all()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip(f"{FOLDER} is not there")
    return duck(FOLDER)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


def test_flagship(spark, con):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, QUERIES[name], SQL[name]) is None
