"""Every registered query against its SQL counterpart, and the driver's entry points."""

import pytest

import __spark_entry__ as entry
from foliospark.plans.oracle import statements
from foliospark.plans.queries import QUERIES
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(statements())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert difference(entry.queries()[name](spark, SMALL), duck, entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "page_id"
