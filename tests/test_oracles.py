import pytest
from oracle import differences, views

from lexmesh.plans import oracles, queries

#: Named here, so that a query that is lost is missed.
NAMES = sorted(queries.queries())


@pytest.fixture(scope="module")
def con(sf):
    return views(sf)


def test_every_query_has_its_sql():
    assert set(NAMES) == set(oracles.oracle_sql())
    assert len(NAMES) >= 106


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf, con, name):
    assert differences(spark, con, queries.queries()[name], oracles.oracle_sql()[name], sf) == ""
