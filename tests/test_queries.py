"""Every registered query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as driver
from compare import compare, duck
from cashline.plans.registry import all_queries
from conftest import SF_DIR

OWN = all_queries()
QUERIES = {name: query for name, query in driver.queries().items() if name in OWN}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
