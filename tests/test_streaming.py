"""Incremental extraction: what has landed is extracted once, whenever and however often it lands."""

import os
from datetime import date

from pyspark.sql import functions as F

from conftest import SF_SMALL
from repotrend.params import Window
from repotrend.plans.extraction import extract_days
from repotrend.sources import feed as feeds
from repotrend.sources import raw, tables
from repotrend.streaming.incremental import run_incremental_extract


def test_incremental_extract_processes_only_new_hours(spark, tmp_root):
    rawdir, out, ck = tmp_root + "/raw", tmp_root + "/curated", tmp_root + "/_ck"
    events = feeds.with_forkee(feeds.feed(spark, SF_SMALL))
    day = F.to_date("event_ts")
    first = events.where(day < F.lit("2024-01-15").cast("date"))
    later = events.where(day >= F.lit("2024-01-15").cast("date"))
    kinds = F.col("event_type").isin("WatchEvent", "ForkEvent")

    raw.land_raw(raw.to_raw_lines(first), rawdir)
    run_incremental_extract(spark, rawdir, out, ck)
    n1 = tables.read_curated(spark, out).count()
    assert n1 == first.where(kinds).count()

    run_incremental_extract(spark, rawdir, out, ck)  # nothing new: nothing added
    assert tables.read_curated(spark, out).count() == n1

    raw.land_raw(raw.to_raw_lines(later), rawdir)
    run_incremental_extract(spark, rawdir, out, ck, max_files_per_trigger=50)
    got = tables.read_curated(spark, out)
    assert got.count() == events.where(kinds).count()
    assert got.select("kind").distinct().count() == 2
    assert got.where(F.col("file_date") != F.col("event_date")).count() == 0


def _land(spark, root, ids, hour="2024-01-10 05:00:00"):
    rows = spark.createDataFrame([(str(i),) for i in ids], "event_id string").withColumns({
        "event_type": F.lit("WatchEvent"), "event_ts": F.lit(hour).cast("timestamp"), "is_public": F.lit(True),
        "repo_id": F.lit(1).cast("long"), "repo_name": F.lit("o/r"), "actor_id": F.lit(1).cast("long"), "actor_login": F.lit("u"),
        "org_id": F.lit(None).cast("long"), "org_login": F.lit(None).cast("string"), "action": F.lit("started")})
    return raw.land_raw(raw.to_raw_lines(rows), root)


def _ids(spark, out):
    return sorted(r.event_id for r in tables.read_curated(spark, out).collect())


def test_old_files_relanded_hours_and_batch_runs_share_the_table(spark, tmp_root):
    rawdir, out, ck = tmp_root + "/raw", tmp_root + "/curated", tmp_root + "/_ck"
    window = Window(date(2024, 1, 9), date(2024, 1, 11))
    run = lambda: run_incremental_extract(spark, rawdir, out, ck, window=window)
    _land(spark, rawdir, [1, 2])
    run()
    [file] = _land(spark, rawdir, [3], "2024-01-09 01:00:00")
    os.utime(file.removeprefix("file:"), (1_500_000_000, 1_500_000_000))  # far older than what was seen
    run()
    assert _ids(spark, out) == ["1", "2", "3"]
    _land(spark, rawdir, [1, 4])  # the first hour again, with other rows, under its old name
    run()
    assert _ids(spark, out) == ["1", "3", "4"]
    run()
    extract_days(spark, rawdir, out, [date(2024, 1, 10)])  # a batch run on the same table
    assert _ids(spark, out) == ["1", "3", "4"]
    _land(spark, rawdir, [5], "2024-01-11 00:00:00")
    run()
    assert _ids(spark, out) == ["1", "3", "4", "5"]
