"""Golden tests on hand-made rows for the semantics a naive build gets wrong."""

from datetime import date

from pyspark.sql import functions as F

from helpers import ev, fact, frame, rows
from repotrend.operators import facts, marts, staging

A = "2024-01-30"


def test_dedupe_is_distinct_over_full_row(spark):
    src = frame(spark, [
        ev("1", "2024-01-10 10:00:00", 5, "o/r"),
        ev("1", "2024-01-10 10:00:00", 5, "o/r"),                    # exact copy: collapses
        ev("2", "2024-01-10 11:00:00", 5, "o/r"),
        ev("2", "2024-01-10 11:00:00", 5, "o/r", action="other"),    # same id, other content: both stay
        ev(None, "2024-01-10 11:00:00", 5, "o/r"),                   # no id: dropped
        ev("3", "2024-01-10 11:00:00", None, "o/r"),                 # no repo: dropped
    ])
    staged = staging.stage_events(src)
    assert staged.count() == 3
    assert sorted(r.event_id for r in staged.collect()) == ["1", "2", "2"]
    assert staged.columns[3] == "event_date"
    # the step-by-step form gives the same rows
    assert rows(staging.stage_events_stepwise(src)) == rows(staged)


def test_non_duplicate_single_aggregate_matches_join_form(spark):
    src = staging.required_keys(frame(spark, [
        ev("1", "2024-01-10 10:00:00", 5, "o/r"),
        ev("2", "2024-01-10 10:00:00", 5, "o/r"),
        ev("2", "2024-01-10 10:00:00", 5, "o/r"),
        ev("3", "2024-01-11 10:00:00", 6, "o/s"),
    ]))
    once = staging.non_duplicate_events(src)
    by_join = src.join(staging.unique_event_ids(src), "event_id", "left_semi")
    assert rows(once) == rows(by_join.select(*src.columns))
    assert sorted(r.event_id for r in staging.duplicate_events(src).collect()) == ["2", "2"]
    assert staging.dedup_duplicates(src).count() == 1


def test_fact_grain_includes_name_and_null_names_do_not_match(spark):
    w = staging.stage_events(frame(spark, [
        ev("1", "2024-01-10 10:00:00", 3, "o/old"),
        ev("2", "2024-01-10 12:00:00", 3, "o/new"),      # rename within the day: two rows
        ev("3", "2024-01-10 12:00:00", 4, None),         # NULL name
    ]))
    f = staging.stage_events(frame(spark, [
        ev("9", "2024-01-10 13:00:00", 4, None, kind="fork"),
        ev("8", "2024-01-10 13:00:00", 3, "o/new", kind="fork"),
    ], kind="fork"))
    d = date(2024, 1, 10)
    expected = [
        (d, 3, "o/new", 1, 1),
        (d, 3, "o/old", 1, 0),
        (d, 4, None, 0, 1),
        (d, 4, None, 1, 0),
    ]
    assert rows(facts.repo_daily_fact_join(w, f)) == rows(spark.createDataFrame(expected, facts.repo_daily_fact(w, f).schema))
    assert rows(facts.repo_daily_fact(w, f)) == rows(facts.repo_daily_fact_join(w, f))


def test_windows_are_half_open_and_exclude_anchor_day(spark):
    fc = fact(spark, [
        ("2024-01-23", 1, "a", 5, 0),   # first day of the current week
        ("2024-01-29", 1, "a", 5, 0),
        ("2024-01-30", 1, "a", 100, 0),  # anchor day: excluded
        ("2024-01-22", 1, "a", 7, 0),   # last day of previous week
        ("2024-01-16", 1, "a", 1, 0),   # first day of previous week
        ("2024-01-15", 1, "a", 1000, 0),  # outside both
    ])
    assert marts.weekly_watch(fc, A).collect()[0].weekly_watch_count == 10
    assert marts.prev_week_watch(fc, A).collect()[0].prev_week_watch_count == 8


def test_top_k_ties_are_deterministic_and_zero_rows_can_appear(spark):
    fc = fact(spark, [("2024-01-25", i, f"r{i}", 3 if i < 4 else 0, 1) for i in range(12, 0, -1)])
    top = marts.top_watched(fc, A, k=5)
    assert [r.repo_id for r in top.collect()] == [1, 2, 3, 4, 5]
    assert [r.weekly_watch_count for r in top.collect()] == [3, 3, 3, 0, 0]


def test_rising_keeps_decliners_and_null_names_get_no_previous_week(spark):
    fc = fact(spark, [
        ("2024-01-25", 1, "up", 30, 0), ("2024-01-18", 1, "up", 10, 0),
        ("2024-01-25", 2, "down", 20, 0), ("2024-01-18", 2, "down", 50, 0),
        ("2024-01-25", 3, None, 25, 0), ("2024-01-18", 3, None, 40, 0),
        ("2024-01-18", 4, "gone", 90, 0),                 # previous week only: dropped
        ("2024-01-25", 5, "small", 19, 0),                # below min_count
        ("2024-01-25", 6, "forks", 0, 3),                 # current-week row with 0 watches
    ])
    got = {(r.repo_id, r.repo_name): r for r in marts.rising_repos(fc, A).collect()}
    assert set(got) == {(1, "up"), (2, "down"), (3, None)}
    assert got[(2, "down")].watch_count_delta == -30
    assert got[(3, None)].prev_week_watch_count == 0
    assert abs(got[(1, "up")].watch_growth_ratio - 31.0 / 11.0) < 1e-12
    order = [r.repo_id for r in marts.rising_repos(fc, A).collect()]
    assert order == [3, 1, 2]  # deltas 25 (NULL name, prev 0), 20, -30
    for m in (0, 20):
        assert rows(marts.rising_repos(fc, A, m)) == rows(marts.rising_repos_join(fc, A, m))
    all_ = {r.repo_id for r in marts.rising_repos(fc, A, 0).collect()}
    assert 4 not in all_ and 6 in all_


def test_intent_classes_thresholds_and_zero_watch_balanced(spark):
    fc = fact(spark, [
        ("2024-01-25", 1, "usage", 5, 6),      # 6/5 = 1.2 -> usage_driven (double, not decimal)
        ("2024-01-25", 2, "interest", 40, 20),  # 0.5 -> interest_driven
        ("2024-01-25", 3, "zero", 0, 25),       # ratio NULL -> balanced
        ("2024-01-25", 4, "bal", 20, 15),       # 0.75 -> balanced
        ("2024-01-25", 5, "low", 19, 19),       # low_signal: excluded
    ])
    act = {r.repo_id: r.activity_label for r in marts.repo_activity(marts.weekly_watch_fork(fc, A)).collect()}
    assert act == {1: "low_signal", 2: "active", 3: "active", 4: "active", 5: "low_signal"}
    fc2 = fact(spark, [
        ("2024-01-25", 1, "usage", 20, 24),
        ("2024-01-25", 2, "interest", 40, 20),
        ("2024-01-25", 3, "zero", 0, 25),
        ("2024-01-25", 4, "bal", 20, 15),
    ])
    intent = {r.repo_id: r.repo_intent_type
              for r in marts.repo_intent(marts.repo_activity(marts.weekly_watch_fork(fc2, A))).collect()}
    assert intent == {1: "usage_driven", 2: "interest_driven", 3: "balanced", 4: "balanced"}
    rates = {r.intent_type: r.rate for r in marts.intent_rates_for(fc2, A).collect()}
    assert rates == {"usage_driven": 0.25, "interest_driven": 0.25, "balanced": 0.5}


def test_intent_rates_on_no_active_repo_are_three_null_rows(spark):
    fc = fact(spark, [("2024-01-25", 1, "low", 1, 1)])
    got = marts.intent_rates_for(fc, A).collect()
    assert [r.intent_type for r in got] == ["usage_driven", "interest_driven", "balanced"]
    assert all(r.rate is None for r in got)
    assert dict(marts.intent_rates_for(fc, A).dtypes)["rate"] == "double"


def test_ratio_types_are_double(spark):
    fc = fact(spark, [("2024-01-25", 1, "a", 21, 0), ("2024-01-18", 1, "a", 3, 0)])
    r = marts.rising_repos(fc, A)
    assert dict(r.dtypes)["watch_growth_ratio"] == "double"
    assert dict(r.dtypes)["watch_count_delta"] == "bigint"
    assert r.collect()[0].watch_growth_ratio == 22.0 / 4.0


def test_required_keys_drop_null_ts(spark):
    src = frame(spark, [ev("1", "2024-01-10 10:00:00", 5, "o/r")]).union(
        frame(spark, [ev("2", "2024-01-10 10:00:00", 5, "o/r")]).withColumn("event_ts", F.lit(None).cast("timestamp"))
    )
    assert [r.event_id for r in staging.stage_events(src).collect()] == ["1"]
