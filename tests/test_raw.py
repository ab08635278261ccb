"""Raw JSON landing, pruned scans, extraction and rerun-safe curated writes."""

import gzip
import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import rows
from repotrend import schema as S
from repotrend.operators import extract
from repotrend.params import Window
from repotrend.plans.extraction import RawMissing, extract_days
from repotrend.sources import feed as feeds
from repotrend.sources import manifest, raw, tables


def _write_hour(root, d, hour, objs, text_lines=()):
    folder = os.path.join(root, f"year={d[:4]}", f"month={d[5:7]}", f"day={d[8:10]}", f"hour={hour:02d}")
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, f"{d}-{hour}.json.gz"), "wt") as fh:
        for o in objs:
            fh.write(json.dumps(o) + "\n")
        for line in text_lines:
            fh.write(line + "\n")


def _obj(i, ts, kind="WatchEvent", repo=7, org=True, forkee=False):
    o = {"id": str(i), "type": kind, "created_at": ts, "public": True,
         "actor": {"id": 1, "login": "u1"}, "repo": {"id": repo, "name": f"o/r{repo}"},
         "payload": {"action": "started"} if kind == "WatchEvent" else {}}
    if org:
        o["org"] = {"id": 3, "login": "org3"}
    if forkee:
        o["payload"]["forkee"] = {"id": 99, "full_name": "u1/fork"}
    return o


def test_roundtrip_feed_to_raw_and_back(spark, tmp_root):
    f = feeds.feed(spark, SF_SMALL)
    raw.land_raw(raw.to_raw_lines(feeds.with_forkee(f)), tmp_root)
    back = extract.extract_events(raw.read_raw(spark, tmp_root))
    expected = feeds.with_forkee(f).where(F.col("event_type").isin("WatchEvent", "ForkEvent")).select(
        *[F.date_trunc("second", "event_ts").alias("event_ts") if c == "event_ts" else F.col(c)
          for c in S.FORK_SOURCE_COLUMNS]
    )
    assert rows(back.select(*S.FORK_SOURCE_COLUMNS)) == rows(expected)
    # one file per landed hour, hour directory zero-padded
    days = manifest.dates_spanning(f)
    landed = raw.landed_hours(spark, tmp_root, [r.file_date for r in days.collect()])
    assert sum(map(len, landed.values())) == f.select(F.date_trunc("hour", "event_ts")).distinct().count()
    names = {n for _, _, files in os.walk(tmp_root) for n in files if not n.startswith((".", "_"))}
    assert "2024-01-15-3.json.gz" in names and all(n.endswith(".json.gz") for n in names)
    assert any(p.startswith("hour=0") for _, dirs, _ in os.walk(tmp_root) for p in dirs)


def test_malformed_line_bad_timestamp_and_missing_struct(spark, tmp_root):
    _write_hour(tmp_root, "2024-01-10", 5, [
        _obj(1, "2024-01-10T05:00:01Z", org=False),            # no org at all that day
        _obj(2, "not-a-time"),                                 # bad timestamp -> NULL
        _obj(3, "2024-01-10T05:10:00Z", kind="ForkEvent"),     # fork without forkee
        _obj(4, "2024-01-10T05:20:00Z", kind="PushEvent"),
    ], text_lines=["{not json"])
    got = {r.event_id: r for r in extract.build_watch(raw.read_raw(spark, tmp_root)).collect()}
    assert set(got) == {"1", "2"}
    assert got["1"].org_id is None and got["1"].event_hour == 5
    assert got["2"].event_ts is None and got["2"].event_date is None
    forks = extract.build_fork(raw.read_raw(spark, tmp_root)).collect()
    assert [(r.event_id, r.forkee_repo_id) for r in forks] == [("3", None)]


def test_straggler_keeps_event_date_and_rerun_does_not_erase_neighbour(spark, tmp_root):
    rawdir, cur = os.path.join(tmp_root, "raw"), os.path.join(tmp_root, "curated")
    _write_hour(rawdir, "2024-01-09", 23, [_obj(1, "2024-01-09T23:30:00Z")])
    _write_hour(rawdir, "2024-01-10", 0, [
        _obj(2, "2024-01-10T00:05:00Z"),
        _obj(3, "2024-01-09T23:59:59Z"),                        # straggler of D-1 in D's file
        _obj(4, "2024-01-10T00:06:00Z", kind="ForkEvent", forkee=True),
    ])
    days = [date(2024, 1, 9), date(2024, 1, 10)]
    extract_days(spark, rawdir, cur, days)
    c = tables.read_curated(spark, cur, "watch")
    got = {r.event_id: (r.file_date, r.event_date) for r in c.collect()}
    assert got["3"] == (date(2024, 1, 10), date(2024, 1, 9))
    # re-extract D only: D-1's partition stays, D's is replaced, nothing doubles
    extract_days(spark, rawdir, cur, days[1:])
    extract_days(spark, rawdir, cur, days[1:])
    ids = lambda: sorted(r.event_id for r in tables.read_curated(spark, cur).collect())
    assert ids() == ["1", "2", "3", "4"]
    # a kind that D no longer has loses its partition
    _write_hour(rawdir, "2024-01-10", 0, [_obj(2, "2024-01-10T00:05:00Z"), _obj(3, "2024-01-09T23:59:59Z")])
    extract_days(spark, rawdir, cur, days[1:])
    assert ids() == ["1", "2", "3"]
    # D-1's raw file is gone: its curated rows stay, and asking for it is an error
    import shutil

    shutil.rmtree(os.path.join(rawdir, "year=2024", "month=01", "day=09"))
    with pytest.raises(RawMissing) as gone:
        extract_days(spark, rawdir, cur, days)
    assert gone.value.days == days[:1] and ids() == ["1", "2", "3"]
    kept = extract_days(spark, rawdir, cur, days, missing="keep")
    assert (kept.dates, kept.without_raw) == (days[1:], days[:1]) and ids() == ["1", "2", "3"]
    with pytest.raises(ValueError, match="no landed hours"):
        tables.write_curated(extract.extract_events(raw.read_raw(spark, rawdir)), cur, {days[0]: {}})
    # a failed extraction replaces nothing
    with pytest.raises(Exception, match="boom|DIVIDE"):
        broken = extract.extract_events(raw.read_raw(spark, rawdir, dates=days[1:])).withColumn("event_id", F.expr("raise_error('boom')"))
        tables.write_curated(broken, cur, raw.landed_hours(spark, rawdir, days))
    assert ids() == ["1", "2", "3"]


def test_late_hours_make_a_day_pending(spark, tmp_root):
    rawdir, cur, day = os.path.join(tmp_root, "raw"), os.path.join(tmp_root, "curated"), date(2024, 1, 10)
    pending = lambda: tables.pending_dates(spark, cur, [day], raw.landed_hours(spark, rawdir, [day]))
    assert pending() == [day]
    _write_hour(rawdir, "2024-01-10", 0, [_obj(1, "2024-01-10T00:05:00Z")])
    extract_days(spark, rawdir, cur, [day], only_pending=True)
    assert pending() == []  # a day without forks is complete as well
    _write_hour(rawdir, "2024-01-10", 1, [_obj(2, "2024-01-10T01:05:00Z")])
    assert pending() == [day]
    assert extract_days(spark, rawdir, cur, [day], only_pending=True).dates == [day]
    assert pending() == [] and tables.read_curated(spark, cur).count() == 2
    tables.delete_path(spark, f"{cur}/kind=watch/file_date=2024-01-10")
    assert pending() == [day]


def test_first_landing_and_empty_files(spark, tmp_root):
    window, root = Window(date(2024, 1, 9), date(2024, 1, 11)), os.path.join(tmp_root, "raw")
    wanted = manifest.with_manifest(manifest.hours_between(spark, "2024-01-10 00:00:00", "2024-01-10 02:00:00"), "https://h", "raw")
    missing = lambda: [r.file_name for r in manifest.missing_hours(wanted, manifest.landed_objects(spark, root, window, "raw")).orderBy("hour_ts").collect()]
    names = [f"2024-01-10-{h}.json.gz" for h in range(3)]
    assert missing() == names
    os.makedirs(root)
    assert missing() == names
    _write_hour(root, "2024-01-10", 1, [_obj(1, "2024-01-10T01:00:00Z")])
    empty = os.path.join(root, "year=2024", "month=01", "day=10", "hour=02")
    os.makedirs(empty)
    open(os.path.join(empty, names[2]), "w").close()
    assert missing() == [names[0], names[2]]
    events = [(f"{h}", "WatchEvent", f"2024-01-{d} 0{h}:00:00") for d in (10, 12) for h in range(3)]
    df = spark.createDataFrame(events, "event_id string, event_type string, t string").withColumn("event_ts", F.col("t").cast("timestamp"))
    for c in ("is_public", "repo_id", "repo_name", "actor_id", "actor_login", "org_id", "org_login", "action"):
        df = df.withColumn(c, F.lit(None))
    assert sorted(os.path.basename(f) for f in raw.land_missing(raw.to_raw_lines(df), root, window)) == [names[0], names[2]]
    assert missing() == [] and raw.read_raw(spark, root).count() == 3
    assert raw.read_raw(spark, root, "2024-02-01", "2024-02-02").count() == 0


def test_only_the_wanted_days_are_listed(spark, tmp_root):
    for d in range(1, 9):
        _write_hour(tmp_root, f"2024-01-0{d}", 1, [_obj(d, f"2024-01-0{d}T01:00:00Z")])
    files = raw.read_raw(spark, tmp_root, "2024-01-03", "2024-01-03").inputFiles()
    assert len(files) == 1 and "day=03" in files[0]
    plan = raw.read_raw(spark, tmp_root, "2024-01-03", "2024-01-04")._jdf.queryExecution().executedPlan().toString()
    assert "(2 paths)" in plan
    cur = tmp_root + "_cur"
    extract_days(spark, tmp_root, cur, Window.of("2024-01-01", "2024-01-08").dates())
    one = tables.read_curated(spark, cur, "watch", "2024-01-05", "2024-01-05")
    assert len(one.inputFiles()) == 1 and [r.event_id for r in one.collect()] == ["5"]
    assert tables.read_curated(spark, cur + "-none").columns == one.columns


def test_scan_is_partition_pruned_with_declared_schema(spark, tmp_root):
    _write_hour(tmp_root, "2024-01-10", 1, [_obj(1, "2024-01-10T01:00:00Z")])
    _write_hour(tmp_root, "2024-01-11", 1, [_obj(2, "2024-01-11T01:00:00Z")])
    df = extract.extract_events(raw.read_raw(spark, tmp_root, "2024-01-11", "2024-01-11"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(type" in plan or "PushedFilters: [IsNotNull(type), In(type" in plan
    assert [r.event_id for r in df.collect()] == ["2"]


def test_malformed_lines_are_counted(spark, tmp_root):
    _write_hour(tmp_root, "2024-01-10", 5, [_obj(1, "2024-01-10T05:00:01Z")], text_lines=["{not json", '{"id": "7", "ty'])
    done = extract_days(spark, tmp_root, tmp_root + "_cur", [date(2024, 1, 10)])
    assert (done.lines, done.malformed) == (3, 2)
    [r] = raw.malformed(raw.read_raw(spark, tmp_root, with_corrupt=True)).collect()
    assert (r.n_lines, r.n_malformed) == (3, 2)


def test_manifest_names_and_window(spark):
    from datetime import datetime, timezone

    from repotrend.params import ingest_window

    w = ingest_window(datetime(2024, 2, 1, 3, 40, tzinfo=timezone.utc))
    m = manifest.with_manifest(manifest.hours_between(spark, w.start, w.end), "https://h.example", "raw")
    assert m.count() == 14 * 24 + 1
    r = m.orderBy("hour_ts").first()
    assert r.file_name == "2024-01-18-0.json.gz"
    assert r.object_path == "raw/year=2024/month=01/day=18/hour=00/2024-01-18-0.json.gz"
    assert r.url == "https://h.example/2024-01-18-0.json.gz"
