"""Row counts of every layer against the expected-count table of
FIXTURES.md (sf0.01 column, computed independently)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from repotrend.operators import marts
from repotrend.plans import pipeline
from repotrend.sources import feed as feeds

A = "2024-01-30"


@pytest.fixture(scope="module")
def layers(spark):
    return pipeline.in_memory_layers(spark, SF_MID, written=True)


def test_feed_and_staging_counts(spark, layers):
    f = feeds.feed(spark, SF_MID)
    assert f.count() == 11200
    assert f.where("event_type = 'WatchEvent'").count() == 2035
    assert f.where("event_type = 'ForkEvent'").count() == 2740
    sw, sf = layers["stg_watch_events"], layers["stg_fork_events"]
    assert (sw.count(), sf.count()) == (1848, 2479)
    multi = lambda df: df.groupBy("event_id").count().where("count > 1").count()
    assert (multi(sw), multi(sf)) == (38, 34)


def test_fact_counts(layers):
    fc = layers["fct_repo_daily"]
    assert fc.count() == 708
    assert fc.where("repo_name is null").count() == 111
    split = fc.where("repo_name is null").groupBy("event_date", "repo_id").count().where("count = 2")
    assert split.count() == 3


def test_mart_branch_counts(layers):
    fc = layers["fct_repo_daily"]
    act = marts.repo_activity(marts.weekly_watch_fork(fc, A))
    assert act.count() == 35
    assert act.where("activity_label = 'low_signal'").count() == 15
    intent = marts.repo_intent(act)
    by = {r.repo_intent_type: r["count"] for r in intent.groupBy("repo_intent_type").count().collect()}
    assert by == {"usage_driven": 9, "interest_driven": 4, "balanced": 7}
    assert intent.where("repo_intent_type = 'balanced' and weekly_watch_count = 0").count() == 1
    rising = marts.rising_repos(fc, A)
    assert rising.count() == 16
    assert rising.where("watch_count_delta < 0").count() == 2
    assert rising.where("prev_week_watch_count = 0").count() == 1


def test_covered_dates(layers):
    for model in ("source_watch_events", "source_fork_events"):
        d = F.to_date("event_ts")
        n = (layers[model].where((d >= F.date_sub(F.lit(A).cast("date"), 14)) & (d < F.lit(A).cast("date")))
             .select(d.alias("d")).distinct().count())
        assert n == 14
