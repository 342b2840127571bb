"""Every registered query against its SQL at the smallest scale; queries without SQL must return rows."""

import pytest
from check import compare, oracle_connection

from seriesml.plans.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(data):
    return oracle_connection(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, data, name):
    df = QUERIES[name](spark, data)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
