"""Plan shapes, data-quality gates and the gated end-to-end run."""

import pytest

from conftest import SF_SMALL
from repotrend import queries as Q
from repotrend import schema as S
from repotrend.operators import facts, marts
from repotrend.plans import pipeline, quality
from repotrend.plans.run import run
from repotrend.sources import feed as feeds
from repotrend.sources import raw, tables
from repotrend.session import work_dir


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_take_ordered_not_full_sort(spark):
    p = _plan(Q.q_mart_top_watch(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    assert "Sort [" not in p.split("TakeOrderedAndProject")[1]


def test_no_cartesian_or_nested_loop_joins_anywhere(spark):
    for name in ("fct_repo_daily_join", "mart_rising_join", "duplicate_events", "dq_report"):
        p = _plan(Q.QUERIES[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_window_predicate_reaches_the_events_scan(spark):
    p = _plan(Q.q_mart_top_watch(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-23" in p


def test_fused_fact_needs_fewer_exchanges_than_join_form(spark):
    src = feeds.sources(spark, SF_SMALL)
    from repotrend.operators import staging

    w, f = staging.stage_events(src["watch"]), staging.stage_events(src["fork"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fused = _plan(facts.repo_daily_fact(w, f)).count("Exchange hashpartitioning")
        joined = _plan(facts.repo_daily_fact_join(w, f)).count("Exchange hashpartitioning")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert fused == 3 and joined == 4


def test_stepwise_staging_joins_once_for_each_side_of_a_union(spark):
    from repotrend.operators import staging

    kinds = [spark.createDataFrame(
        [(str(i), 1, i % 3, f"o/r{k}") for i in (*range(k, k + 6), k)], "event_id string, kind int, repo_id int, repo_name string") for k in range(3)]
    src = kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for step in (staging.non_duplicate_events, staging.duplicate_events):
            p = _plan(step(src))
            assert p.count("SortMergeJoin") == 1, p
        rows = [r for k in range(3) for i in (*range(k, k + 6), k) for r in [(str(i), 1, i % 3, f"o/r{k}")]]
        times = {i: sum(r[0] == i for r in rows) for i in {r[0] for r in rows}}
        assert sorted(map(tuple, staging.non_duplicate_events(src).collect())) == sorted(r for r in rows if times[r[0]] == 1)
        assert sorted(map(tuple, staging.duplicate_events(src).collect())) == sorted(r for r in rows if times[r[0]] > 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fused_rising_reads_the_fact_once(spark):
    fc = Q._fact(spark, SF_SMALL)
    assert marts.rising_repos(fc, Q.ANCHOR).count() == marts.rising_repos_join(fc, Q.ANCHOR).count()
    once = _plan(marts.rising_repos(fc, Q.ANCHOR)).count("Scan parquet")
    twice = _plan(marts.rising_repos_join(fc, Q.ANCHOR)).count("Scan parquet")
    assert once * 2 == twice


def test_fact_table_read_prunes_date_partitions(spark):
    target = work_dir(spark) + "/fact"
    tables.write_fact(Q._fact(spark, SF_SMALL), target)
    p = _plan(tables.read_fact(spark, target, "2024-01-23", "2024-01-29"))
    assert "PartitionFilters: [isnotnull(event_date" in p


def test_quality_report_counts_and_gate(spark):
    layers = pipeline.in_memory_layers(spark, SF_SMALL)
    rep = {(r.model, r.test, r.column_name): r for r in pipeline.quality_report(layers, Q.ANCHOR).collect()}
    assert len(rep) == 36
    assert rep[("source_watch_events", "not_null", "event_id")].status == "fail"
    assert rep[("source_watch_events", "unique", "event_id")].status == "warn"
    assert rep[("stg_fork_events", "unique", "event_id")].status == "fail"
    assert rep[("fct_repo_daily_watch_fork_metrics", "not_null", "repo_name")].failures == 10
    assert rep[("source_fork_events", "date_coverage", "event_ts")].status == "pass"
    with pytest.raises(quality.DataQualityError):
        quality.gate(pipeline.quality_report(layers, Q.ANCHOR))
    clean = pipeline.in_memory_layers(spark, SF_SMALL, clean=True)
    rows = quality.gate(pipeline.quality_report(clean, Q.ANCHOR))  # warnings only: no raise
    assert {r["status"] for r in rows} == {"pass", "warn"}


def test_failing_rows_forms(spark):
    src = feeds.sources(spark, SF_SMALL)["watch"]
    assert quality.not_null_failures(src, "event_id").count() > 0
    assert set(quality.unique_failures(src, "event_id").columns) == {"unique_field", "n_records"}
    acc = quality.accepted_values_failures(feeds.feed(spark, SF_SMALL), "event_type", ("WatchEvent",))
    assert {r.value_field for r in acc.collect()} == {"ForkEvent", "PushEvent"}
    assert quality.date_coverage_failures(src, "event_ts", "2024-01-30", 14).count() == 0
    assert quality.date_coverage_failures(src, "event_ts", "2024-01-02", 14).first().distinct_date_count == 1


def test_gated_run_stops_on_error_and_passes_on_clean_feed(spark):
    out = work_dir(spark)
    clean_raw = Q._landed(spark, SF_SMALL, clean=True)
    res = run(spark, clean_raw, out + "/ok", Q.ANCHOR)
    assert len(res.checks) == 36
    assert res.table(spark, S.TOP_WATCH_TABLE).count() == 10
    assert res.table(spark, S.INTENT_TABLE).count() == 3
    plain_raw = Q._landed(spark, SF_SMALL)
    with pytest.raises(quality.DataQualityError) as err:
        run(spark, plain_raw, out + "/bad", Q.ANCHOR, missing_raw="keep")
    # at this scale the NULL ids fall outside the window: staging is the first
    # layer with an error (duplicate fork ids); nothing after it was written
    assert {(r["model"], r["test"]) for r in err.value.failed} == {("stg_fork_events", "unique")}
    assert not tables.path_exists(spark, out + "/bad/" + S.FACT_TABLE)


def test_run_fails_coverage_when_a_day_is_missing(spark, tmp_root):
    f = feeds.with_forkee(feeds.feed(spark, SF_SMALL, clean=True))
    from pyspark.sql import functions as F

    raw.land_raw(raw.to_raw_lines(f.where(F.to_date("event_ts") != F.lit("2024-01-20").cast("date"))), tmp_root)
    from repotrend.plans.extraction import RawMissing

    with pytest.raises(RawMissing):
        run(spark, tmp_root, tmp_root + "_out", Q.ANCHOR)
    assert not tables.path_exists(spark, tmp_root + "_out")
    with pytest.raises(quality.DataQualityError) as err:
        run(spark, tmp_root, tmp_root + "_out", Q.ANCHOR, missing_raw="keep")
    assert {r["test"] for r in err.value.failed} == {"date_coverage"}


def test_run_skips_dates_already_extracted(spark):
    out = work_dir(spark)
    clean_raw = Q._landed(spark, SF_SMALL, clean=True)
    first = run(spark, clean_raw, out, Q.ANCHOR, skip_extracted=True)
    assert len(first.extracted_dates) == 14
    top1 = sorted(tuple(r) for r in first.table(spark, S.TOP_WATCH_TABLE).collect())
    # remove one date's fork partition: only that date is extracted again
    tables.delete_path(spark, out + "/curated/kind=fork/file_date=2024-01-20")
    second = run(spark, clean_raw, out, Q.ANCHOR, skip_extracted=True)
    from datetime import date

    assert second.extracted_dates == [date(2024, 1, 20)]
    assert sorted(tuple(r) for r in second.table(spark, S.TOP_WATCH_TABLE).collect()) == top1


def test_other_windows_and_single_layers(spark):
    out = work_dir(spark)
    clean_raw = Q._landed(spark, SF_SMALL, clean=True)
    first = run(spark, clean_raw, out, Q.ANCHOR, days=14, lag_days=2)
    assert len(first.extracted_dates) == 13
    assert len(run(spark, clean_raw, work_dir(spark), Q.ANCHOR, days=7, layers=("extract", "source")).extracted_dates) == 7
    again = run(spark, clean_raw, out, Q.ANCHOR, days=14, lag_days=2, layers=["marts"])
    assert {r["layer"] for r in again.checks} == {"marts"} and again.extracted_dates == []
    for bad in ({"days": 1, "lag_days": 2}, {"lag_days": 0}, {"layers": ["nothing"]}):
        with pytest.raises(ValueError):
            run(spark, clean_raw, out + "/never", Q.ANCHOR, **bad)
    assert not tables.path_exists(spark, out + "/never")


def test_tables_and_views_by_name(spark):
    clean_raw = Q._landed(spark, SF_SMALL, clean=True)
    out, database = work_dir(spark), "named_run"
    plain = run(spark, clean_raw, work_dir(spark), Q.ANCHOR)
    for _ in range(2):  # a second run replaces what the names stand for
        res = run(spark, clean_raw, out, Q.ANCHOR, database=database)
    for name in [*S.KIND_TO_SOURCE_TABLE.values(), *S.STAGED_TABLES.values(), S.FACT_TABLE, S.TOP_WATCH_TABLE, S.RISING_TABLE, S.INTENT_TABLE]:
        by_name = spark.sql(f"SELECT * FROM {database}.{name}")
        n = plain.table(spark, name).count()
        assert by_name.count() == res.table(spark, name).count() == n and (n > 0 or name == S.RISING_TABLE), name
    assert not tables.path_exists(spark, res.paths["stg_watch_events"])
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_failed_rebuilds_keep_the_old_table(spark, tmp_root):
    tables.write_table(spark.range(3), tmp_root + "/t")
    with pytest.raises(Exception, match="boom"):
        tables.write_table(spark.range(3).selectExpr("if(id = 2, raise_error('boom'), id) AS id"), tmp_root + "/t")
    assert tables.read_table(spark, tmp_root + "/t").count() == 3
    assert tables.replace_table(spark.range(0), tmp_root + "/t", least=1) == 0 and tables.read_table(spark, tmp_root + "/t").count() == 3
    spark.range(1).selectExpr("id", "1 AS p").write.partitionBy("p").parquet(tmp_root + "/own")
    spark.range(1).selectExpr("id", "2 AS p").write.mode("overwrite").partitionBy("p").parquet(tmp_root + "/own")
    assert spark.read.parquet(tmp_root + "/own").count() == 1  # the session's overwrite mode is the caller's


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from repotrend.session import checkpoint_dir

    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_step_aggregates_hash_ids_only(spark):
    p = _plan(Q.QUERIES["non_duplicate_events_watch"](spark, SF_SMALL))
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p


def test_marts_of_a_run_share_one_pass(spark):
    fc = Q._fact(spark, SF_SMALL)
    weeks = marts.week_frame(fc, Q.ANCHOR)
    shared = {k: sorted(map(str, v.collect())) for k, v in marts.marts_of(weeks).items()}
    assert shared == {k: sorted(map(str, v.collect())) for k, v in pipeline.mart_layer(fc, Q.ANCHOR).items()}
    assert "Sort [" not in _plan(marts.marts_of(weeks)[S.RISING_TABLE])
