"""Queries of the subpackage that SQL can express, against DuckDB on the smallest tables."""

import pytest

from compare import compare, duck
from conftest import SF_SMALL
from mailsync.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_one_query_per_operator():
    assert sorted(int(x[2:].split("_")[0]) for x in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, msg
