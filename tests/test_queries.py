"""Every registered query against its SQL on the smallest tables."""

import pytest

import check
from streamloom.catalog import ORACLES, QUERIES



@pytest.fixture(scope="module")
def oracle(sf):
    return check.oracle_connection(sf)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, sf, oracle, name):
    problem = check.compare(spark, oracle, sf, name)
    assert problem is None, problem
