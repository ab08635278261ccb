"""Every registered query against its DuckDB oracle (small scale; the
driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from repotrend.oracle import ORACLE
from repotrend.queries import QUERIES

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["repo_id", "repo_name", "weekly_watch_count"]
    assert 0 < df.count() <= 10


@pytest.fixture(scope="module")
def duck():
    from tools.oracle_check import duck as connect

    return connect(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    from tools.oracle_check import compare

    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, duck)
    assert r["ok"], r
