"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each runs the library over the whole ``events`` table of a test-data folder
(through the feed binding in :mod:`repotrend.sources.feed`), anchored at
2024-01-30.  The matching DuckDB SQL is in :mod:`repotrend.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotrend import schema as S
from repotrend.operators import extract, facts, marts, staging
from repotrend.params import Window, ingest_window, partition_date, run_window
from repotrend.plans import pipeline, quality
from repotrend.plans.extraction import extract_days
from repotrend.plans.run import run
from repotrend.session import checkpoint_dir, configure, work_dir
from repotrend.sources import feed as feeds
from repotrend.sources import layout, manifest, raw, tables
from repotrend.streaming.incremental import run_incremental_extract

ANCHOR = feeds.FIXTURE_ANCHOR
_A = date.fromisoformat(ANCHOR)
# The fourteen loaded dates of a run for the anchor, a one-day probe, and a
# day of which an hour lands late.
RUN = run_window(_A)
WINDOW = (RUN.start, RUN.end)
PROBE_DATE = date(2024, 1, 15)
LATE_DATE = date(2024, 1, 20)
# An ingest job started three hours into 2024-02-01 (two days of the
# default window lie past the fixture data, so they are still missing).
INGEST_NOW = datetime(2024, 2, 1, 3, 0, tzinfo=timezone.utc)
ARCHIVE_URL = "https://archive.example.org"
RAW_PREFIX = "raw"

Query = Callable[[SparkSession, str], DataFrame]


def _source(spark: SparkSession, sf_dir: str, kind: str, clean: bool = False) -> DataFrame:
    configure(spark)
    return feeds.source_events(feeds.feed(spark, sf_dir, clean=clean), kind)


def _staged(spark: SparkSession, sf_dir: str, kind: str, clean: bool = False) -> DataFrame:
    return staging.stage_events(_source(spark, sf_dir, kind, clean))


def _required(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return staging.required_keys(_source(spark, sf_dir, kind))


def _fact(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    return facts.repo_daily_fact(
        _staged(spark, sf_dir, "watch", clean), _staged(spark, sf_dir, "fork", clean)
    )


def _fact_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.repo_daily_fact_join(_staged(spark, sf_dir, "watch"), _staged(spark, sf_dir, "fork"))


_LANDED: dict[tuple, str] = {}
_CURATED: dict[tuple, str] = {}


def _state(spark: SparkSession, sf_dir: str, clean: bool = False) -> tuple:
    """What a landed copy was made of: the session's shared folder and the table's files as they are now."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    files = layout.children(spark, path)
    return checkpoint_dir(spark), clean, path, *files


def _lines(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    """The feed as raw lines, and some of them a second time cut off in the middle."""
    configure(spark)
    events = feeds.with_forkee(feeds.feed(spark, sf_dir, clean=clean))
    broken = raw.to_raw_lines(events.where("cast(event_id as bigint) % 211 = 0")).withColumn("value", F.substring("value", 1, 25))
    return raw.to_raw_lines(events).unionByName(broken)


def _landed(spark: SparkSession, sf_dir: str, clean: bool = False) -> str:
    """Land the feed as raw hourly JSON, once for each state of the table."""
    key = _state(spark, sf_dir, clean)
    root = _LANDED.get(key)
    if root is None or not layout.path_exists(spark, root):
        root = work_dir(spark) + "/raw"
        raw.land_raw(_lines(spark, sf_dir, clean), root)
        _LANDED[key] = root
    return root


def _curated(spark: SparkSession, sf_dir: str) -> str:
    """Extract the run window of the landed plain feed, once for each state of the table."""
    raw_root = _landed(spark, sf_dir)
    root = _CURATED.get(raw_root)
    if root is None or not layout.path_exists(spark, root):
        root = work_dir(spark) + "/curated"
        extract_days(spark, raw_root, root, RUN.dates(), missing="keep")
        _CURATED[raw_root] = root
    return root


def _dates(spark: SparkSession, days: list[date]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in days], "file_date date")


# ---------------------------------------------------------------- staging

def q_relevant_events(spark, sf_dir):
    """Feed rows of the two kinds the pipeline keeps."""
    configure(spark)
    rows = extract.relevant_events(feeds.feed(spark, sf_dir).withColumnRenamed("event_type", "type"))
    return rows.withColumnRenamed("type", "event_type")


def _step(function, kind, spark, sf_dir):
    """One step of staging over the required rows of a kind."""
    return function(_required(spark, sf_dir, kind))


def q_stg_stepwise(kind, spark, sf_dir):
    """The step-by-step form: registered to show that it equals the one-step form."""
    return staging.stage_events_stepwise(_source(spark, sf_dir, kind))


def q_stg_watch_events(spark, sf_dir):
    return _staged(spark, sf_dir, "watch")


def q_stg_fork_events(spark, sf_dir):
    return _staged(spark, sf_dir, "fork")


STEPS = {
    "stg_required_keys": lambda rows: rows,
    "event_id_counts": staging.event_id_counts,
    "unique_event_ids": staging.unique_event_ids,
    "duplicate_event_ids": staging.duplicate_event_ids,
    "non_duplicate_events": staging.non_duplicate_events,
    "duplicate_events": staging.duplicate_events,
    "dedup_duplicates": staging.dedup_duplicates,
}


# ------------------------------------------------------------------- fact

def q_daily_watch_counts(spark, sf_dir):
    return facts.daily_watch_counts(_staged(spark, sf_dir, "watch"))


def q_daily_fork_counts(spark, sf_dir):
    return facts.daily_fork_counts(_staged(spark, sf_dir, "fork"))


def q_fct_repo_daily(spark, sf_dir):
    return _fact(spark, sf_dir)


def q_fct_repo_daily_join(spark, sf_dir):
    return _fact_join(spark, sf_dir)


def _skewed(spark, sf_dir, kind):
    configure(spark)
    return feeds.source_events(feeds.feed(spark, sf_dir, text=feeds.SKEWED_FEED_SQL), kind)


def q_fct_skewed(spark, sf_dir):
    """The fact of a feed with very many repositories, one of which has a third of the rows."""
    return facts.repo_daily_fact(*[staging.stage_events(_skewed(spark, sf_dir, k)) for k in ("watch", "fork")])


def q_weekly_watch_skewed(spark, sf_dir):
    return marts.weekly_watch(q_fct_skewed(spark, sf_dir), ANCHOR)


def q_duplicate_events_skewed(spark, sf_dir):
    """Events whose id occurs more than once, where one id has a third of the rows."""
    return staging.duplicate_events(staging.required_keys(_skewed(spark, sf_dir, "watch")))


def _bucketed(spark, sf_dir, kind):
    """The kind's source rows loaded in buckets by event id, by name."""
    root = work_dir(spark)
    load = tables.stage_bucketed(_source(spark, sf_dir, kind), root, "repotrend_" + root.rpartition("/")[2], S.KIND_TO_SOURCE_TABLE[kind], "event_id")
    tables.publish(spark, root, tables.Version((load,)))
    return tables.read_table(spark, root)


def q_bucketed(function, kind, spark, sf_dir):
    """A step over the bucketed source: no event is shuffled after the load."""
    return function(_bucketed(spark, sf_dir, kind))


BUCKETED = {
    "stg_events_bucketed": staging.stage_events,
    "duplicate_events_bucketed": lambda rows: staging.duplicate_events(staging.required_keys(rows), split_hot=False),
    "dq_unique_bucketed": lambda rows: quality.unique_failures(staging.stage_events(rows), "event_id"),
}


# ------------------------------------------------------------------ marts

def q_weekly_watch(spark, sf_dir):
    return marts.weekly_watch(_fact(spark, sf_dir), ANCHOR)


def q_weekly_fork(spark, sf_dir):
    return marts.weekly_fork(_fact(spark, sf_dir), ANCHOR)


def q_prev_week_watch(spark, sf_dir):
    return marts.prev_week_watch(_fact(spark, sf_dir), ANCHOR)


def q_weekly_watch_fork(spark, sf_dir):
    return marts.weekly_watch_fork(_fact(spark, sf_dir), ANCHOR)


def q_mart_top_watch(spark, sf_dir):
    return marts.top_watched(_fact(spark, sf_dir), ANCHOR)


def q_mart_top_fork(spark, sf_dir):
    return marts.top_forked(_fact(spark, sf_dir), ANCHOR)


def q_mart_rising(spark, sf_dir):
    return marts.rising_repos(_fact(spark, sf_dir), ANCHOR)


def q_mart_rising_join(spark, sf_dir):
    return marts.rising_repos_join(_fact(spark, sf_dir), ANCHOR)


def q_mart_rising_all(spark, sf_dir):
    """No volume floor, so NULL-name repos (which never match a previous
    week) are in the result."""
    return marts.rising_repos(_fact(spark, sf_dir), ANCHOR, min_count=0)


def q_repo_activity(spark, sf_dir):
    return marts.repo_activity(marts.weekly_watch_fork(_fact(spark, sf_dir), ANCHOR))


def q_repo_intent(spark, sf_dir):
    return marts.repo_intent(q_repo_activity(spark, sf_dir))


def q_mart_intent_rates(spark, sf_dir):
    return marts.intent_rates(q_repo_intent(spark, sf_dir))


# ---------------------------------------------------------------- quality

def q_dq_not_null(spark, sf_dir):
    """Fact rows failing repo_name not_null."""
    return quality.not_null_failures(_fact(spark, sf_dir), "repo_name")


def q_dq_unique(kind, spark, sf_dir):
    """Staged event ids of a kind held by more than one distinct row."""
    return quality.unique_failures(_staged(spark, sf_dir, kind), "event_id")


def q_dq_accepted_values(spark, sf_dir):
    """Feed event types outside the two kinds the pipeline keeps."""
    configure(spark)
    return quality.accepted_values_failures(feeds.feed(spark, sf_dir), "event_type",
                                            ("WatchEvent", "ForkEvent"))


def q_dq_date_coverage(spark, sf_dir):
    """Fourteen days before the anchor are all covered: no failing row."""
    return quality.date_coverage_failures(_source(spark, sf_dir, "watch"), "event_ts", ANCHOR, 14)


def q_dq_date_coverage_month(spark, sf_dir):
    """Thirty days reach before the first fixture day: one failing row."""
    return quality.date_coverage_failures(_source(spark, sf_dir, "fork"), "event_ts", ANCHOR, 30)


def q_dq_report(spark, sf_dir):
    """All 36 checks over every layer of the plain feed (which fails some
    error-severity checks on purpose)."""
    layers = pipeline.in_memory_layers(spark, sf_dir, written=True)
    return pipeline.quality_report(layers, ANCHOR)


# ------------------------------------------------------- manifest / dates

def q_hour_manifest(spark, sf_dir):
    """Landing manifest for every hour the feed spans."""
    configure(spark)
    hours = manifest.hours_spanning(feeds.feed(spark, sf_dir))
    return manifest.with_manifest(hours, ARCHIVE_URL, RAW_PREFIX)


def q_missing_hours(spark, sf_dir):
    """Hours of the default ingest window with no landed file."""
    hours = ingest_window(INGEST_NOW)
    wanted = manifest.with_manifest(manifest.hours_between(spark, hours.start, hours.end), ARCHIVE_URL, RAW_PREFIX)
    days = Window.of(hours.start, hours.end)
    return manifest.missing_hours(wanted, manifest.landed_objects(spark, _landed(spark, sf_dir), days, RAW_PREFIX))


def q_missing_hours_first_run(spark, sf_dir):
    """Before anything has landed, all hours of the feed are missing."""
    nothing = manifest.landed_objects(spark, work_dir(spark) + "/raw", RUN, RAW_PREFIX)
    return manifest.missing_hours(q_hour_manifest(spark, sf_dir), nothing)


def q_transform_dates(spark, sf_dir):
    """The dates a transform loads by default as of the feed's last event."""
    configure(spark)
    return manifest.transform_dates(feeds.feed(spark, sf_dir))


def q_partition_date_counts(spark, sf_dir):
    """Events of each type on the last date that a run of the anchor day counts on."""
    configure(spark)
    day = F.lit(partition_date(ANCHOR))
    return feeds.feed(spark, sf_dir).where(F.to_date("event_ts") == day).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def q_date_spine(spark, sf_dir):
    configure(spark)
    return manifest.dates_spanning(feeds.feed(spark, sf_dir))


def _pending(spark, raw_root, curated, days):
    return _dates(spark, tables.pending_dates(spark, curated, days, raw.landed_hours(spark, raw_root, days)))


def q_pending_dates(spark, sf_dir):
    """Dates of the feed of which not all landed hours are extracted."""
    days = [r.file_date for r in q_date_spine(spark, sf_dir).collect()]
    return _pending(spark, _landed(spark, sf_dir), _curated(spark, sf_dir), days)


def q_pending_after_late_hour(spark, sf_dir):
    """An hour that lands after its day was extracted makes the day pending again."""
    root = work_dir(spark)
    lines = _lines(spark, sf_dir)
    on_day = f"year = '{LATE_DATE:%Y}' AND month = '{LATE_DATE:%m}' AND day = '{LATE_DATE:%d}'"
    late = lines.where(on_day).agg(F.min("hour")).first()[0]
    raw.land_raw(lines.where(f"NOT ({on_day} AND hour = '{late}')"), f"{root}/raw")
    extract_days(spark, f"{root}/raw", f"{root}/curated", RUN.dates(), missing="keep")
    raw.land_missing(lines, f"{root}/raw", RUN)
    landed = raw.landed_hours(spark, f"{root}/raw", RUN.dates())
    return _pending(spark, f"{root}/raw", f"{root}/curated", sorted(landed))


# ----------------------------------------------------------- raw / extract

def q_raw_scan_pruned(spark, sf_dir):
    """One day's raw events (only that day's hour files are read)."""
    day = raw.read_raw(spark, _landed(spark, sf_dir), PROBE_DATE, PROBE_DATE)
    return raw.flatten_raw(day.where("type IS NOT NULL"))  # lines that are no JSON have none


def q_raw_roundtrip(spark, sf_dir):
    """Feed -> raw JSON -> both kinds extracted."""
    return extract.extract_events(raw.read_raw(spark, _landed(spark, sf_dir)))


def q_extract_watch(spark, sf_dir):
    return extract.build_watch(raw.read_raw(spark, _landed(spark, sf_dir)))


def q_extract_fork(spark, sf_dir):
    return extract.build_fork(raw.read_raw(spark, _landed(spark, sf_dir)))


def q_extract_range(spark, sf_dir):
    """The curated table after extracting the run window."""
    return tables.read_curated(spark, _curated(spark, sf_dir))


def q_extract_missing_raw(spark, sf_dir):
    """Extracting again when a day's raw files are gone keeps the day's curated rows."""
    root = work_dir(spark)
    raw.land_raw(_lines(spark, sf_dir), f"{root}/raw")
    extract_days(spark, f"{root}/raw", f"{root}/curated", RUN.dates(), missing="keep")
    layout.delete_path(spark, layout.raw_day(f"{root}/raw", LATE_DATE))
    extract_days(spark, f"{root}/raw", f"{root}/curated", RUN.dates(), missing="keep")
    return tables.read_curated(spark, f"{root}/curated")


def q_land_skip_existing(spark, sf_dir):
    """Landing some hours and then what is missing gives each hour once."""
    root = work_dir(spark) + "/raw"
    lines = _lines(spark, sf_dir)
    raw.land_raw(lines.where("day < '15'"), root)
    bounds = q_date_spine(spark, sf_dir).agg(F.min("file_date"), F.max("file_date")).first()
    raw.land_missing(lines, root, Window(*bounds))
    return extract.extract_events(raw.read_raw(spark, root))


def q_raw_corrupt_counts(spark, sf_dir):
    """Lines of each landed day, and how many are no JSON objects."""
    return raw.malformed(raw.read_raw(spark, _landed(spark, sf_dir), with_corrupt=True))


def q_stream_extract(spark, sf_dir):
    """Incremental (availableNow file stream) extraction of all landed hours."""
    raw_root = _landed(spark, sf_dir)
    out = work_dir(spark)
    run_incremental_extract(spark, raw_root, out + "/curated", out + "/_checkpoint", window=RUN)
    return tables.read_curated(spark, out + "/curated")


# ------------------------------------------------------------------ tables

def q_curated_range_scan(spark, sf_dir):
    """Fork rows of the last seven loaded dates (partition-pruned)."""
    root = _curated(spark, sf_dir)
    return tables.read_curated(spark, root, "fork", _A - timedelta(days=7), WINDOW[1]).select(
        *S.source_columns("fork")
    )


def q_load_truncate(spark, sf_dir):
    root, target = _curated(spark, sf_dir), work_dir(spark) + "/source_watch_events"
    for _ in range(2):  # a rerun replaces, not doubles
        tables.load_source(spark, root, "watch", *WINDOW, target, tables.WRITE_TRUNCATE)
    return tables.read_table(spark, target)


def q_load_append(spark, sf_dir):
    root, target = _curated(spark, sf_dir), work_dir(spark) + "/source_watch_events"
    mid = _A - timedelta(days=8)
    tables.load_source(spark, root, "watch", WINDOW[0], mid, target, tables.WRITE_TRUNCATE)
    tables.load_source(spark, root, "watch", mid + timedelta(days=1), WINDOW[1], target,
                       tables.WRITE_APPEND)
    return tables.read_table(spark, target)


def q_load_append_retried(spark, sf_dir):
    """Two loads with ids, each made twice as after a lost driver: their rows are there once."""
    root, target = _curated(spark, sf_dir), work_dir(spark) + "/source_watch_events"
    mid = _A - timedelta(days=8)
    for _ in range(2):
        tables.load_source(spark, root, "watch", WINDOW[0], mid, target, tables.WRITE_APPEND, load_id="early")
    for _ in range(2):
        tables.load_source(spark, root, "watch", mid + timedelta(days=1), WINDOW[1], target, tables.WRITE_APPEND, load_id="late")
    return tables.read_table(spark, target)


def q_load_empty(spark, sf_dir):
    root, target = _curated(spark, sf_dir), work_dir(spark) + "/source_fork_events"
    tables.create_empty(spark, "fork", target)
    tables.load_source(spark, root, "fork", *WINDOW, target, tables.WRITE_EMPTY)
    return tables.read_table(spark, target)


def q_loaded_rows(spark, sf_dir):
    """What loading each kind reports: its table and the table's rows."""
    root, target = _curated(spark, sf_dir), work_dir(spark)
    rows = [(k, t, tables.load_source(spark, root, k, *WINDOW, f"{target}/{t}")) for k, t in S.KIND_TO_SOURCE_TABLE.items()]
    return spark.createDataFrame(rows, "kind string, table_name string, n long")


def q_fct_pruned_read(spark, sf_dir):
    """Fact written partitioned by event_date, read back for one week."""
    target = work_dir(spark) + "/" + S.FACT_TABLE
    tables.write_fact(_fact(spark, sf_dir), target)
    return tables.read_fact(spark, target, _A - timedelta(days=7), _A - timedelta(days=1))


def q_fct_one_repo(spark, sf_dir):
    """The rows of one repository from the written fact: files of other ranges of repositories are skipped."""
    target = work_dir(spark) + "/" + S.FACT_TABLE
    tables.write_fact(_fact(spark, sf_dir), target)
    return tables.read_fact(spark, target).where("repo_id = 11")


# ------------------------------------------------------------- end to end

def _plain_run(spark, sf_dir, **more):
    """A run over the whole feed, whose failed checks are reported and don't stop it."""
    return run(spark, _landed(spark, sf_dir), work_dir(spark), ANCHOR, enforce=False, missing_raw="keep", **more)


def q_run_pipeline(spark, sf_dir):
    """Raw JSON of the whole feed -> every layer -> top-10 watched."""
    return _plain_run(spark, sf_dir).table(spark, S.TOP_WATCH_TABLE)


def q_run_pipeline_rising(spark, sf_dir):
    return _plain_run(spark, sf_dir).table(spark, S.RISING_TABLE)


def q_run_gated(spark, sf_dir):
    """The run with its gates on, over rows that pass them."""
    result = run(spark, _landed(spark, sf_dir, clean=True), work_dir(spark), ANCHOR)
    return result.table(spark, S.TOP_WATCH_TABLE)


def q_run_plain_report(spark, sf_dir):
    """All checks of a run over the whole feed."""
    rows = _plain_run(spark, sf_dir).checks
    return spark.createDataFrame(
        [tuple(r[c] for c in ("layer", "model", "test", "column_name", "severity", "failures", "status")) for r in rows],
        "layer string, model string, test string, column_name string, severity string, failures long, status string")


def q_gate_stop(spark, sf_dir):
    """The failed checks that stop a run over the whole feed."""
    try:
        run(spark, _landed(spark, sf_dir), work_dir(spark), ANCHOR, missing_raw="keep")
        failed = []
    except quality.DataQualityError as stop:
        failed = [(r["model"], r["test"], r["column_name"], r["failures"]) for r in stop.failed]
    return spark.createDataFrame(failed, "model string, test string, column_name string, failures long")


def _nameless(spark, sf_dir):
    """The clean feed with the names of one repository lost: extraction, source and staging checks pass, the fact's don't."""
    events = feeds.with_forkee(feeds.feed(spark, sf_dir, clean=True))
    return raw.to_raw_lines(events.withColumn("repo_name", F.expr("if(repo_id = 11, null, repo_name)")))


def q_gate_keeps_fact(spark, sf_dir):
    """A run whose fact checks fail leaves the fact of the run before: read by name."""
    out = work_dir(spark)
    database = "repotrend_" + out.rpartition("/")[2]
    run(spark, _landed(spark, sf_dir, clean=True), out, ANCHOR, database=database)
    raw.land_raw(_nameless(spark, sf_dir), f"{out}/nameless")
    try:
        run(spark, f"{out}/nameless", out, ANCHOR, database=database)
        raise AssertionError("the fact checks have passed")
    except quality.DataQualityError as stop:
        if {r["layer"] for r in stop.failed} != {"fact"}:
            raise
    return spark.table(f"{database}.{S.FACT_TABLE}").select(*S.FACT_COLUMNS)


def q_run_tables_sql(spark, sf_dir):
    """Plain SQL on the marts of a run, by name."""
    database = "repotrend_" + work_dir(spark).rpartition("/")[2]
    _plain_run(spark, sf_dir, database=database)
    return spark.sql(
        f"SELECT repo_id, repo_name, weekly_watch_count, weekly_fork_count FROM {database}.{S.TOP_WATCH_TABLE} "
        f"JOIN {database}.{S.TOP_FORK_TABLE} USING (repo_id, repo_name)")


QUERIES: dict[str, Query] = {
    "hour_manifest": q_hour_manifest,
    "missing_hours": q_missing_hours,
    "date_spine": q_date_spine,
    "pending_dates": q_pending_dates,
    "raw_scan_pruned": q_raw_scan_pruned,
    "raw_roundtrip": q_raw_roundtrip,
    "extract_watch": q_extract_watch,
    "extract_fork": q_extract_fork,
    "extract_range": q_extract_range,
    "stream_extract": q_stream_extract,
    "curated_range_scan": q_curated_range_scan,
    "load_truncate": q_load_truncate,
    "load_append": q_load_append,
    "load_append_retried": q_load_append_retried,
    "load_empty": q_load_empty,
    "fct_pruned_read": q_fct_pruned_read,
    "fct_one_repo": q_fct_one_repo,
    "run_pipeline": q_run_pipeline,
    "run_pipeline_rising": q_run_pipeline_rising,
    "relevant_events": q_relevant_events,
    "stg_watch_events": q_stg_watch_events,
    "stg_fork_events": q_stg_fork_events,
    "daily_watch_counts": q_daily_watch_counts,
    "daily_fork_counts": q_daily_fork_counts,
    "fct_repo_daily": q_fct_repo_daily,
    "fct_repo_daily_join": q_fct_repo_daily_join,
    "fct_skewed": q_fct_skewed,
    "weekly_watch_skewed": q_weekly_watch_skewed,
    "duplicate_events_skewed": q_duplicate_events_skewed,
    "weekly_watch": q_weekly_watch,
    "weekly_fork": q_weekly_fork,
    "prev_week_watch": q_prev_week_watch,
    "weekly_watch_fork": q_weekly_watch_fork,
    "mart_top_watch": q_mart_top_watch,
    "mart_top_fork": q_mart_top_fork,
    "mart_rising": q_mart_rising,
    "mart_rising_join": q_mart_rising_join,
    "mart_rising_all": q_mart_rising_all,
    "repo_activity": q_repo_activity,
    "repo_intent": q_repo_intent,
    "mart_intent_rates": q_mart_intent_rates,
    "dq_not_null": q_dq_not_null,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_date_coverage": q_dq_date_coverage,
    "dq_date_coverage_month": q_dq_date_coverage_month,
    "dq_report": q_dq_report,
    "missing_hours_first_run": q_missing_hours_first_run,
    "transform_dates": q_transform_dates,
    "partition_date_counts": q_partition_date_counts,
    "pending_after_late_hour": q_pending_after_late_hour,
    "extract_missing_raw": q_extract_missing_raw,
    "land_skip_existing": q_land_skip_existing,
    "raw_corrupt_counts": q_raw_corrupt_counts,
    "loaded_rows": q_loaded_rows,
    "run_gated": q_run_gated,
    "run_plain_report": q_run_plain_report,
    "gate_stop": q_gate_stop,
    "gate_keeps_fact": q_gate_keeps_fact,
    "run_tables_sql": q_run_tables_sql,
}
for _kind in S.KIND_TO_EVENT_TYPE:
    QUERIES |= {f"{name}_{_kind}": partial(_step, step, _kind) for name, step in STEPS.items()}
    QUERIES |= {f"{name}_{_kind}": partial(q_bucketed, step, _kind) for name, step in BUCKETED.items()}
    QUERIES |= {f"stg_{_kind}_events_stepwise": partial(q_stg_stepwise, _kind), f"dq_unique_{_kind}": partial(q_dq_unique, _kind)}
# The names under which steps were first registered, each for one kind.
QUERIES |= {name: QUERIES[f"{name}_watch"] for name in ("stg_required_keys", "event_id_counts", "non_duplicate_events")}
QUERIES |= {name: QUERIES[f"{name}_fork"] for name in ("unique_event_ids", "duplicate_event_ids", "duplicate_events", "dedup_duplicates", "dq_unique")}
