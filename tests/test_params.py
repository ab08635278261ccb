"""Run parameters and table-layer guards."""

from datetime import date, datetime, timezone

import pytest

from repotrend import params
from repotrend import schema as S
from repotrend.sources import tables


def test_anchor_resolution():
    assert params.anchor_date("2024-01-30") == date(2024, 1, 30)
    now = datetime(2024, 3, 1, 23, 30, tzinfo=timezone.utc)
    assert params.anchor_date(None, now) == date(2024, 3, 1)
    assert params.anchor_date("  ", now) == date(2024, 3, 1)
    assert params.as_date(now) == date(2024, 3, 1)
    with pytest.raises(ValueError, match="not a calendar date"):
        params.as_date("30/01/2024")


def test_hours_need_an_offset_and_are_floored():
    assert params.as_utc_hour("2024-01-05T10:59:59Z") == datetime(2024, 1, 5, 10, tzinfo=timezone.utc)
    assert params.as_utc_hour("2024-01-05T12:30:00+02:00") == datetime(2024, 1, 5, 10, tzinfo=timezone.utc)
    with pytest.raises(ValueError, match="no UTC offset"):
        params.as_utc_hour("2024-01-05T10:00:00")


def test_windows():
    w = params.ingest_window(datetime(2024, 2, 1, 3, 10, tzinfo=timezone.utc))
    assert (w.end - w.start).days == 14 and int((w.end - w.start).total_seconds() // 3600) + 1 == 337
    assert params.transform_window(datetime(2024, 2, 1, 2, 0, tzinfo=timezone.utc)) == params.Window(
        date(2024, 1, 18), date(2024, 1, 31))
    run = params.run_window("2024-01-30")
    assert (run.start, run.end) == (date(2024, 1, 16), date(2024, 1, 29)) and len(run.dates()) == 14
    assert params.partition_date("2024-01-30") == date(2024, 1, 29)
    assert len(params.run_window("2024-01-30", 7, 2).dates()) == 6
    with pytest.raises(ValueError, match="after its end"):
        params.Window.of("2024-01-02", "2024-01-01")
    for days, lag in ((7, 0), (2, 3), (0, 0)):
        with pytest.raises(ValueError, match="lag_days"):
            params.run_window("2024-01-30", days, lag)


def test_kind_routing():
    assert S.KIND_TO_SOURCE_TABLE == {"watch": "source_watch_events", "fork": "source_fork_events"}
    with pytest.raises(ValueError, match="no such kind"):
        S.check_kind("push")
    assert len(S.WATCH_COLUMNS) == 13 and len(S.FORK_COLUMNS) == 15


def test_load_guards_and_dispositions(spark, tmp_root):
    from conftest import SF_SMALL
    from repotrend import queries as Q

    cur = Q._curated(spark, SF_SMALL)
    target = tmp_root + "/src"
    with pytest.raises(FileNotFoundError):
        tables.load_source(spark, cur, "watch", "2023-01-01", "2023-01-02", target)
    with pytest.raises(FileNotFoundError):
        tables.load_source(spark, tmp_root + "/nothing", "watch", "2024-01-16", "2024-01-29", target)
    with pytest.raises(ValueError):
        tables.load_source(spark, cur, "watch", "2024-01-16", "2024-01-29", target, "WRITE_SOMETIMES")
    n = tables.load_source(spark, cur, "watch", "2024-01-16", "2024-01-29", target, tables.WRITE_EMPTY)
    assert n > 0
    with pytest.raises(ValueError, match="WRITE_EMPTY can't"):
        tables.load_source(spark, cur, "watch", "2024-01-16", "2024-01-29", target, tables.WRITE_EMPTY)
    assert tables.load_source(spark, cur, "watch", "2024-01-16", "2024-01-29", target, tables.WRITE_APPEND) == 2 * n
    assert tables.load_source(spark, cur, "watch", "2024-01-16", "2024-01-29", target) == n


def test_the_package_is_shipped(spark):
    import os

    from pyspark import SparkFiles

    from repotrend.session import ship

    def package_paths(batches):
        import sys

        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([str(any(p.endswith("repotrend.zip") for p in sys.path))] * batch.num_rows)], ["p"])

    ship(spark)
    assert os.path.exists(SparkFiles.get("repotrend.zip"))
    paths = spark.range(4).repartition(2).mapInArrow(package_paths, "p string").collect()
    assert {r.p for r in paths} == {"True"}
