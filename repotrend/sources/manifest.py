"""Hour and date series, landing manifest and landed-file listing.

The manifest names, for every UTC hour of a window (both ends inclusive),
the archive file ``YYYY-MM-DD-H.json.gz`` (hour not padded), its URL and its
landing path ``<prefix>/year=YYYY/month=MM/day=DD/hour=HH/<file>`` (padded).
Missing hours are the manifest rows whose path isn't among those of the landed
hours: an anti-join with the window's days, which works as well before anything has
landed.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotrend.params import PUBLISH_LAG_HOURS, RUN_DAYS, Window
from repotrend.sources import layout, raw


def _ts(value: datetime | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(value)).cast("timestamp")


def hour_series(frame: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per hour from ``start`` to ``end`` inclusive (``hour_ts``),
    for each row of ``frame`` (usually one row of bounds)."""
    return frame.select(
        F.explode(F.sequence(F.date_trunc("hour", start), F.date_trunc("hour", end),
                             F.expr("interval 1 hour"))).alias("hour_ts")
    )


def hours_between(spark: SparkSession, start: datetime | str, end: datetime | str) -> DataFrame:
    return hour_series(spark.range(1), _ts(start), _ts(end))


def hours_spanning(events: DataFrame, ts_column: str = "event_ts") -> DataFrame:
    """Every hour between the first and the last event (bounds from one
    partial aggregate)."""
    bounds = events.agg(F.min(ts_column).alias("_s"), F.max(ts_column).alias("_e"))
    return hour_series(bounds, F.col("_s"), F.col("_e"))


def date_series(frame: DataFrame, start: Column, end: Column) -> DataFrame:
    return frame.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("file_date"))


def dates_between(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    return date_series(spark.range(1), F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))


def dates_spanning(events: DataFrame, ts_column: str = "event_ts") -> DataFrame:
    bounds = events.agg(F.to_date(F.min(ts_column)).alias("_s"), F.to_date(F.max(ts_column)).alias("_e"))
    return date_series(bounds, F.col("_s"), F.col("_e"))


def with_manifest(hours: DataFrame, base_url: str, prefix: str) -> DataFrame:
    """Add file_name, url and object_path to an ``hour_ts`` column."""
    h = F.col("hour_ts")
    file_name = F.concat(F.date_format(h, "yyyy-MM-dd"), F.lit("-"), F.hour(h).cast("string"),
                         F.lit(".json.gz"))
    path = F.concat(
        F.lit(prefix.rstrip("/")),
        F.lit("/year="), F.date_format(h, "yyyy"),
        F.lit("/month="), F.date_format(h, "MM"),
        F.lit("/day="), F.date_format(h, "dd"),
        F.lit("/hour="), F.date_format(h, "HH"),
        F.lit("/"), file_name,
    )
    return hours.select(
        "hour_ts",
        file_name.alias("file_name"),
        F.concat(F.lit(base_url.rstrip("/") + "/"), file_name).alias("url"),
        path.alias("object_path"),
    )


def transform_dates(events: DataFrame, ts_column: str = "event_ts", lag_hours: int = PUBLISH_LAG_HOURS, days: int = RUN_DAYS) -> DataFrame:
    """The dates a transform loads by default, as of the last event: ``days`` up to that of the last published hour."""
    last = F.to_date(F.max(ts_column) - F.make_interval(hours=F.lit(lag_hours)))
    bounds = events.agg(last.alias("_e")).select(F.date_sub("_e", days - 1).alias("_s"), "_e").where("_e IS NOT NULL")
    return date_series(bounds, F.col("_s"), F.col("_e"))


def landed_objects(spark: SparkSession, raw_root: str, window: Window, prefix: str) -> DataFrame:
    """(object_path, bytes) of the hours landed for the window's days, under the manifest's names."""
    found = raw.signatures(raw.landed(spark, raw_root, window.dates()))  # 24 a day at most
    rows = [
        (f"{layout.raw_day(prefix, day)}/hour={hour:02d}/{day:%Y-%m-%d}-{hour}.json.gz", size)
        for day, hours in found.items() for hour, (_, size, _) in hours.items()
    ]
    return spark.createDataFrame(rows, "object_path string, bytes long")


def missing_hours(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest rows whose object isn't among the landed ones."""
    return manifest.join(landed.select("object_path"), "object_path", "left_anti").select(*manifest.columns)
