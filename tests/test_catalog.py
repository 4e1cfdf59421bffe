import pytest

import __spark_entry__ as entry_module
import check
from fleetstream.plans import catalog, oracle

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.connect(DIRECTORY)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.ORACLES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert check.compare(spark, connection, DIRECTORY, name) == ""
