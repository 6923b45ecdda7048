"""Every registered query against its oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from lumisift.checks import catalog
from lumisift.checks.compare import check, oracle_connection

SMALLEST = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="test tables are not here")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SMALLEST)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, oracle, name):
    verdict, _, _, _ = check(spark, oracle, SMALLEST, name)
    assert verdict == "ok"


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry_points.queries())
    assert set(catalog.ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10
