"""Every registered query against its SQL counterpart, on the smallest tables."""

import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries
from adlumen.plans.catalog import QUERIES
from conftest import TABLES


@pytest.fixture(scope="module")
def duck():
    return compare.oracle_connection(TABLES)


def test_every_query_has_sql():
    assert QUERIES.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare.compare(queries()[name](spark, TABLES), duck, oracle_sql()[name]) is None


def test_entry_is_the_flagship_query(spark):
    assert entry(spark).columns[0] == "advertiser_id"
