"""Every registered query against the checking engine on the given tables."""

import os

import pytest

import __spark_entry__ as entry
from lauter.plans.catalog import QUERIES
from lauter.plans.oracles import ORACLES
from tests.compare import difference, open_tables

FOLDER = os.environ.get("LAUTER_TEST_TABLES", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def engine():
    return open_tables(FOLDER)


def test_every_query_of_the_engine_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    frame = entry.queries()[name](spark, FOLDER)
    assert difference(frame, engine, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["category", "order_count", "units_sold", "revenue"]
