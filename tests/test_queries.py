"""Every registered query against its SQL, over whole tables at the smallest scale."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from shelfbook.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 5
