"""Every registered query against its DuckDB oracle (the driver's correctness gate, locally)."""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from conftest import SF_SMALL
from mailsync.plans.oracles import ORACLES
from mailsync.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["user_id", "folder_id", "message_id", "removed", "subject",
                                              "received_at"]
