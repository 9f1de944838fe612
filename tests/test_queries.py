"""Every registered query with a SQL twin gives the same rows."""

import pytest

from tallywick.plans import ORACLES, QUERIES
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def database(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, folder, database, name):
    assert differences(QUERIES[name](spark, folder), database, ORACLES[name]) == []


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
