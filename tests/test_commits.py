"""Writes that break off at each step, writes that are repeated, and readers during a rebuild."""

import os
import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from repotrend import queries as Q
from repotrend import schema as S
from repotrend.plans import quality
from repotrend.plans.extraction import extract_days
from repotrend.plans.run import run
from repotrend.sources import feed as feeds
from repotrend.sources import layout, raw, tables
from repotrend.session import work_dir

DAY = date(2024, 1, 10)


class Crash(Exception):
    pass


def lines(spark, ids, hours=(5,), kind="WatchEvent"):
    rows = [(f"{i}", f"2024-01-10 {h:02d}:00:00") for i in ids for h in hours]
    df = spark.createDataFrame(rows, "event_id string, t string").withColumns({
        "event_type": F.lit(kind), "event_ts": F.col("t").cast("timestamp"), "is_public": F.lit(True), "repo_id": F.lit(1).cast("long"),
        "repo_name": F.lit("o/r"), "actor_id": F.lit(1).cast("long"), "actor_login": F.lit("u"), "org_id": F.lit(None).cast("long"),
        "org_login": F.lit(None).cast("string"), "action": F.lit("started")})
    return raw.to_raw_lines(df)


def raw_ids(spark, root):
    return sorted((r.id, r.hour) for r in raw.read_raw(spark, root).collect())


def curated_ids(spark, root):
    return sorted((r.event_id, r.kind) for r in tables.read_curated(spark, root).collect())


def failing(real, after):
    """``real`` that crashes at its call number ``after`` (counted over all threads)."""
    calls, lock = [], threading.Lock()

    def function(*args, **more):
        with lock:
            calls.append(1)
            if len(calls) > after:
                raise Crash
        return real(*args, **more)

    return function


@pytest.mark.parametrize("step", ["first move", "second move", "record", "delete"])
def test_a_landing_that_breaks_off_keeps_the_old_hours(spark, tmp_root, monkeypatch, step):
    raw.land_raw(lines(spark, [1, 2], (5, 6)), tmp_root)
    old = raw_ids(spark, tmp_root)
    assert len(old) == 4
    new = lines(spark, [3], (5, 6, 7))
    with monkeypatch.context() as m:
        if step == "record":
            m.setattr(layout, "put_record", failing(layout.put_record, 0))
        elif step == "delete":
            m.setattr(layout, "delete_path", failing(layout.delete_path, 0))
        else:
            m.setattr(layout, "move", failing(layout.move, 0 if step == "first move" else 2))
        with pytest.raises(Crash):
            raw.land_raw(new, tmp_root)
    done = [("3", 5), ("3", 6), ("3", 7)]
    assert raw_ids(spark, tmp_root) == (done if step == "delete" else old)
    assert sorted(raw.landed_hours(spark, tmp_root, [DAY])[DAY]) == ([5, 6, 7] if step == "delete" else [5, 6])
    raw.land_raw(new, tmp_root)  # and the next one ends the work
    assert raw_ids(spark, tmp_root) == done
    files = [n for _, _, own in os.walk(layout.raw_day(tmp_root, DAY)) for n in own if n.endswith(".gz")]
    assert len(files) == 3


def test_a_large_hour_is_several_files(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(raw, "LINES", 20)
    files = raw.land_raw(lines(spark, range(100), (5,)).union(lines(spark, range(7), (6,))), tmp_root)
    names = sorted(os.path.basename(f) for f in files)
    assert 3 <= len(names) - 1 <= 5 and "2024-01-10-5.json.gz" in names and "2024-01-10-5.1.json.gz" in names and "2024-01-10-6.json.gz" in names
    assert len(raw_ids(spark, tmp_root)) == 107
    with pytest.raises(ValueError, match="no hour"):
        raw.land_raw(lines(spark, [1]).withColumn("hour", F.lit(None).cast("string")), tmp_root)


def test_a_first_landing_that_breaks_off_shows_nothing(spark, tmp_root, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(layout, "move", failing(layout.move, 2))  # the day's first record and one file
        with pytest.raises(Crash):
            raw.land_raw(lines(spark, [1], (5, 6, 7)), tmp_root)
    assert any(n.endswith(".gz") for _, _, own in os.walk(layout.raw_day(tmp_root, DAY)) for n in own)
    assert raw.landed_hours(spark, tmp_root, [DAY]) == {} and raw_ids(spark, tmp_root) == []
    raw.land_missing(lines(spark, [1], (5, 6, 7)), tmp_root, Q.Window(DAY, DAY))
    assert raw_ids(spark, tmp_root) == [("1", 5), ("1", 6), ("1", 7)]


def test_a_landed_file_that_is_gone_is_an_error(spark, tmp_root):
    [file] = raw.land_raw(lines(spark, [1]), tmp_root)
    layout.delete_path(spark, file)
    with pytest.raises(FileNotFoundError, match="2024-01-10-5.json.gz"):
        raw.read_raw(spark, tmp_root)


@pytest.mark.parametrize("step", ["write", "record", "clean"])
def test_an_extraction_that_stops_after_each_step(spark, tmp_root, monkeypatch, step):
    rawdir, cur = tmp_root + "/raw", tmp_root + "/cur"
    raw.land_raw(lines(spark, [1, 2]).union(lines(spark, [7], kind="ForkEvent")), rawdir)
    extract_days(spark, rawdir, cur, [DAY])
    old, pending = curated_ids(spark, cur), lambda: tables.pending_dates(spark, cur, [DAY], raw.landed_hours(spark, rawdir, [DAY]))
    assert old == [("1", "watch"), ("2", "watch"), ("7", "fork")] and pending() == []
    raw.land_raw(lines(spark, [3]), rawdir)  # no fork any more
    with monkeypatch.context() as m:
        name = {"write": "_commit_day", "clean": "_delete_replaced"}.get(step)
        if name:
            m.setattr(tables, name, failing(getattr(tables, name), 0))
        else:
            m.setattr(layout, "move", failing(layout.move, 0))  # of the record to its name
        with pytest.raises(Crash):
            extract_days(spark, rawdir, cur, [DAY])
    new = [("3", "watch")]
    assert (curated_ids(spark, cur), pending()) == ((new, []) if step == "clean" else (old, [DAY]))
    extract_days(spark, rawdir, cur, [DAY])
    assert curated_ids(spark, cur) == new and pending() == []
    assert len(tables._curated_files(spark, cur, DAY)["watch"]) == 1 and not tables._curated_files(spark, cur, DAY)["fork"]


def test_a_first_extraction_that_breaks_off_shows_nothing(spark, tmp_root, monkeypatch):
    rawdir, cur = tmp_root + "/raw", tmp_root + "/cur"
    raw.land_raw(lines(spark, [1]), rawdir)
    with monkeypatch.context() as m:
        m.setattr(tables, "_commit_day", failing(None, 0))
        with pytest.raises(Crash):
            extract_days(spark, rawdir, cur, [DAY])
    assert curated_ids(spark, cur) == []
    extract_days(spark, rawdir, cur, [DAY], only_pending=True)
    assert curated_ids(spark, cur) == [("1", "watch")]


def test_curated_rows_of_a_lost_file_are_an_error(spark, tmp_root):
    rawdir, cur = tmp_root + "/raw", tmp_root + "/cur"
    raw.land_raw(lines(spark, [1]), rawdir)
    extract_days(spark, rawdir, cur, [DAY])
    layout.delete_path(spark, f"{cur}/kind=watch/file_date=2024-01-10")
    with pytest.raises(FileNotFoundError, match="extract their days again"):
        tables.read_curated(spark, cur)
    extract_days(spark, rawdir, cur, [DAY], only_pending=True)
    assert curated_ids(spark, cur) == [("1", "watch")]


def test_a_load_with_an_id_is_there_once(spark, tmp_root, monkeypatch):
    cur, target = Q._curated(spark, SF_SMALL), tmp_root + "/src"
    load = lambda i: tables.load_source(spark, cur, "watch", "2024-01-16", "2024-01-29", target, tables.WRITE_APPEND, load_id=i)
    n = load("a")
    assert load("a") == n and load("b") == 2 * n and load("a") == 2 * n == tables.read_table(spark, target).count()
    with monkeypatch.context() as m:  # the driver is lost between writing the rows and publishing them
        m.setattr(tables, "publish", failing(None, 0))
        with pytest.raises(Crash):
            load("c")
    assert tables.read_table(spark, target).count() == 2 * n
    assert load("c") == 3 * n == tables.read_table(spark, target).count()
    assert sum(x.startswith("v-") for x in os.listdir(target)) == 3  # what was never published is gone
    assert tables.load_source(spark, cur, "watch", "2024-01-16", "2024-01-29", target, load_id="d") == n


def test_readers_during_rebuilds_never_fail(spark, tmp_root):
    target, database = tmp_root + "/t", "rebuilt_" + os.path.basename(tmp_root).replace("-", "_")
    tables.write_table(spark.range(10).selectExpr("id", "0 AS turn"), target)
    tables.register(spark, database, "t", target, tables.current(spark, target))
    seen, failed, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(tables.read_table(spark, target).selectExpr("count(*)", "count(DISTINCT turn)").first()))
                seen.append(tuple(spark.table(f"{database}.t").selectExpr("count(*)", "count(DISTINCT turn)").first()))
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for turn in range(1, 8):
        tables.write_table(spark.range(10).selectExpr("id", f"{turn} AS turn"), target)
        tables.register(spark, database, "t", target, tables.current(spark, target))
    stop.set()
    reader.join()
    assert not failed and set(seen) == {(10, 1)} and len(seen) > 4
    assert spark.table(f"{database}.t").first().turn == 7
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_a_crash_between_staging_and_publishing(spark, tmp_root, monkeypatch):
    target = tmp_root + "/t"
    tables.write_table(spark.range(3), target)
    with monkeypatch.context() as m:
        m.setattr(layout, "move", failing(layout.move, 0))
        with pytest.raises(Crash):
            tables.write_table(spark.range(5), target)
    assert tables.read_table(spark, target).count() == 3
    tables.write_table(spark.range(6), target)
    assert tables.read_table(spark, target).count() == 6
    assert sum(x.startswith("v-") for x in os.listdir(target)) == 2  # this one and the one before


def test_a_failed_gate_leaves_the_layer_as_it_was(spark):
    out, database = work_dir(spark), "kept_" + work_dir(spark).rpartition("/")[2]
    run(spark, Q._landed(spark, SF_SMALL, clean=True), out, Q.ANCHOR, database=database)
    fact, stored = f"{out}/{S.FACT_TABLE}", lambda df: sorted(map(str, df.select(*S.FACT_COLUMNS).collect()))
    before, top = stored(tables.read_fact(spark, fact)), sorted(map(str, spark.table(f"{database}.{S.TOP_WATCH_TABLE}").collect()))
    raw.land_raw(Q._nameless(spark, SF_SMALL), out + "/nameless")
    with pytest.raises(quality.DataQualityError) as err:
        run(spark, out + "/nameless", out, Q.ANCHOR, database=database)
    assert {(r["layer"], r["test"], r["column_name"]) for r in err.value.failed} == {("fact", "not_null", "repo_name")}
    assert stored(tables.read_fact(spark, fact)) == before == stored(spark.table(f"{database}.{S.FACT_TABLE}"))
    assert sorted(map(str, spark.table(f"{database}.{S.TOP_WATCH_TABLE}").collect())) == top
    assert spark.table(f"{database}.{S.STAGED_TABLES['watch']}").where("repo_id = 11 AND repo_name IS NULL").count() > 0  # its checks passed
    run(spark, out + "/nameless", out, Q.ANCHOR, database=database, enforce=False)
    assert stored(spark.table(f"{database}.{S.FACT_TABLE}")) != before
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_a_repository_is_in_few_files_of_a_large_day(spark, tmp_root):
    import glob

    import pyarrow.parquet as pq

    fact = spark.range(200_000).selectExpr("date '2024-01-10' AS event_date", "id % 50000 AS repo_id", "concat('r', id) AS repo_name", "1L AS watch_events_cnt", "0L AS fork_events_cnt")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        tables.write_fact(fact, tmp_root + "/fact")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = glob.glob(f"{tmp_root}/fact/v-*/event_date=2024-01-10/*.parquet")
    bounds = []
    for f in files:
        own = [pq.ParquetFile(f).metadata.row_group(g) for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
        stats = [g.column(k).statistics for g in own for k in range(g.num_columns) if g.column(k).path_in_schema == "repo_id"]
        bounds.append((min(s.min for s in stats), max(s.max for s in stats)))
    assert len(files) > 8
    assert all(sum(lo <= repo <= hi for lo, hi in bounds) <= 2 for repo in range(0, 50_000, 97))
    assert tables.read_fact(spark, tmp_root + "/fact").where("repo_id = 4711").count() == 4


def test_staged_rows_are_made_once_in_a_named_run(spark):
    from repotrend.plans.run import staging_reads

    assert staging_reads(["staging", "fact"]) == 3 and staging_reads(["fact"]) == 1
    out, database = work_dir(spark), "once_" + work_dir(spark).rpartition("/")[2]
    run(spark, Q._landed(spark, SF_SMALL, clean=True), out, Q.ANCHOR, database=database)
    for name in S.STAGED_TABLES.values():
        plan = spark.table(f"{database}.{name}")._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" not in plan and "Exchange" not in plan and "_stored" in spark.table(f"{database}.{name}").inputFiles()[0]
    assert feeds.FIXTURE_ANCHOR == Q.ANCHOR
    spark.sql(f"DROP DATABASE {database} CASCADE")


def _bucketed(spark, rows):
    root, database = work_dir(spark), "bucketed_" + work_dir(spark).rpartition("/")[2]
    load = tables.stage_bucketed(rows, root, database, "source_watch_events", "event_id")
    return root, database, tables.Version((load,))


def test_bucketed_events_are_not_shuffled_again(spark):
    from repotrend.operators import staging

    root, database, version = _bucketed(spark, Q._source(spark, SF_SMALL, "watch"))
    tables.publish(spark, root, version)
    tables.register(spark, database, "source_watch_events", root, version)
    source = spark.table(f"{database}.source_watch_events")
    plain = Q._source(spark, SF_SMALL, "watch")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for step in (staging.stage_events, staging.event_id_counts, lambda df: staging.duplicate_events(staging.required_keys(df), False),
                     lambda df: staging.non_duplicate_events(staging.required_keys(df), False), lambda df: staging.dedup_duplicates(staging.required_keys(df), False),
                     lambda df: quality.unique_failures(df, "event_id")):
            assert "Exchange" not in step(source)._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(str, step(source).collect())) == sorted(map(str, step(plain).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_buckets_are_given_up_for_a_hot_id(spark, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_LEAST", 1)
    rows = spark.range(100_000).selectExpr("cast(id AS string) AS event_id", "uuid() AS other")
    hot = rows.withColumn("event_id", F.expr("if(event_id % 2 = 0, 'hot', event_id)"))
    root, database, version = _bucketed(spark, hot)
    assert version.loads[0].table is None and tables.read_version(spark, root, version).count() == hot.count()
    root, other, version = _bucketed(spark, rows)
    assert version.loads[0].table and tables.read_version(spark, root, version).count() == rows.count()
    for name in (database, other):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_largest_tasks_over_a_skewed_feed():
    """Many keys and one with a third of the rows: no task of a stage reads over five times the median."""
    import json
    import subprocess
    import sys

    out = subprocess.run([sys.executable, "tools/task_shares.py", "/root/testdata/sf0.1"], capture_output=True, text=True, timeout=600, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shares = json.loads(out.stdout.strip().splitlines()[-1])
    assert set(shares) == {"fct_skewed", "weekly_watch_skewed", "duplicate_events_skewed"} and all(shares.values())
    for name, stages in shares.items():
        for largest, middle, tasks in stages:
            assert largest <= 3 * middle and tasks > 8, (name, stages)
