import pytest

import __spark_entry__ as entry_module
import check
from fleetstream.llm import queries

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.connect(DIRECTORY)


def test_registered():
    names = entry_module.queries()
    assert [n for n in names if n.startswith("op")] == list(queries.QUERIES)
    assert len(queries.QUERIES) == 13 and "pipeline" in names
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, connection, name):
    assert check.compare(spark, connection, DIRECTORY, name) == ""
