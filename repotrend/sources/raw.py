"""Raw hourly JSON: landing layout, writer and pruned scan.

Layout: ``<root>/year=YYYY/month=MM/day=DD/hour=HH/<file>.json.gz`` (folders
zero-padded), gzip JSON lines, files named ``YYYY-MM-DD-H.json.gz`` as in the
manifest (a large hour also has ``YYYY-MM-DD-H.1.json.gz`` and so on; an hour that
lands again has the landing's id in its names).

A landing is committed day by day, by a record in the day's ``_commits`` folder
that names the valid files of each of its hours.  Readers take those alone, so an
hour is what it was until its record is there, whenever a landing breaks off; what
the hour had before is deleted last.  A day without records is one that other
tools fill: all its files count, and the first landing into it records them.

Reading uses a declared schema: no inference pass over the files, and a line
that is no JSON object becomes a row of NULLs but for its text, which
:func:`malformed` counts.  A range of dates is read from the folders of those
days alone, with the others never listed.  Gzip is not splittable: one task per
hour file, all hours of all requested days in one job.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotrend import schema as S
from repotrend.params import Window
from repotrend.sources import layout

# Fixed value: the raw ``created_at`` text format (UTC, whole seconds).
CREATED_AT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
LINES = 2_000_000  # of a landed file


def _opt(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None)


def to_raw_lines(events: DataFrame) -> DataFrame:
    """Event rows with source-table columns -> raw JSON lines.

    Returns ``value`` (one JSON object) plus the landing partition columns
    (zero-padded strings) of the event's own hour.  Fork rows carry
    ``payload.forkee`` when the input has forkee columns; absent parts
    (no org, no forkee) are omitted from the object, as in the feed.
    """
    ts = F.col("event_ts")
    at = {path: _opt(events, column).cast(S.COLUMN_TYPES[column]) for column, path in S.RAW_PATHS.items()}

    def part(prefix: str, optional: bool = False) -> Column:
        fields = {path[len(prefix) :]: c for path, c in at.items() if path.startswith(prefix) and "." not in path[len(prefix) :]}
        made = F.struct(*[c.alias(name) for name, c in fields.items()])
        return F.when(F.coalesce(*[c.cast("string") for c in fields.values()]).isNotNull(), made) if optional else made

    obj = F.struct(
        at["id"].alias("id"),
        at["type"].alias("type"),
        F.date_format(ts, CREATED_AT_FORMAT).alias("created_at"),
        at["public"].alias("public"),
        part("actor.").alias("actor"),
        part("repo.").alias("repo"),
        part("org.", optional=True).alias("org"),
        F.struct(at["payload.action"].alias("action"), part("payload.forkee.", optional=True).alias("forkee")).alias("payload"),
    )
    return events.select(
        F.to_json(obj).alias("value"),
        F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
        F.date_format(ts, "HH").alias("hour"),
    )


@dataclass(frozen=True)
class Hour:
    """The valid files of a landed hour: their names with their bytes, and the last modification."""

    files: dict[str, int]
    modified: int

    def signature(self) -> tuple[int, int, int]:
        return len(self.files), sum(self.files.values()), self.modified


Landed = dict[date, dict[int, Hour]]


def _commits(root: str, day: date) -> str:
    return f"{layout.raw_day(root, day)}/_commits"


def _found(spark: SparkSession, root: str, days: list[date]) -> Landed:
    """The non-empty files in the days' folders, whoever put them there."""
    out: Landed = {}
    for path, size, modified in layout.listed(spark, [layout.raw_day(root, d) for d in days], "*.gz"):
        year, month, day, hour, name = (x.partition("=")[2] or x for x in layout.under(path, "year=").split("/"))
        if size and hour.isdigit():
            hours = out.setdefault(date(int(year), int(month), int(day)), {})
            before = hours.get(int(hour), Hour({}, 0))
            hours[int(hour)] = Hour(before.files | {name: size}, max(before.modified, modified))
    return out


def landed(spark: SparkSession, root: str, days: Iterable[date] | None = None) -> Landed:
    """day -> hour -> its valid files, of the given days or of all; days and hours without any are left out."""
    days = layout.all_raw_days(spark, root) if days is None else layout.raw_days(spark, root, days)
    last = dict(zip(days, layout.each(spark, lambda d: layout.last_record(spark, _commits(root, d)), days), strict=True))
    out = _found(spark, root, [d for d in days if last[d] is None])
    for day, record in last.items():
        if record:
            out[day] = {int(h): Hour(x["files"], x["modified"]) for h, x in record.items()}
    return {d: out[d] for d in sorted(out) if out[d]}


def landed_hours(spark: SparkSession, root: str, days: Iterable[date]) -> dict[date, dict[int, tuple[int, int, int]]]:
    """day -> hour -> (files, bytes, last modification) of landed hours."""
    return signatures(landed(spark, root, days))


def signatures(found: Landed) -> dict[date, dict[int, tuple[int, int, int]]]:
    return {day: {h: hour.signature() for h, hour in hours.items()} for day, hours in found.items()}


def _record(hours: dict[int, Hour]) -> dict:
    return {str(h): {"files": x.files, "modified": x.modified} for h, x in hours.items()}


def land_raw(lines: DataFrame, root: str) -> list[str]:
    """Write raw lines as gzip files under the hourly layout; returns the files.

    Lines are dealt by hour, those of an hour with more than ``LINES`` to several
    tasks, so an hour is one file of at most about so many lines or more than one.
    All hours are written beside the layout first and then moved to names that
    nothing has yet, several at a time; a record for each day then makes them the
    valid ones.  Whatever fails before that leaves each hour of the day as it was,
    and hours without rows stay as they are.  A line without an hour is an error.
    """
    spark = lines.sparkSession
    root, mark = root.rstrip("/"), layout.fresh_id()
    beside = f"{root}/_landing-{mark}"
    keyed = lines.select("value", F.concat(*S.RAW_PARTITION_COLUMNS).alias("landing_hour"))
    sizes = {r.landing_hour: r["count"] for r in keyed.groupBy("landing_hour").count().collect()}  # 24 a day at most
    if None in sizes:
        raise ValueError(f"{sizes[None]} line(s) have no hour to be landed under")
    files = spark.createDataFrame([(h, -(-n // LINES)) for h, n in sizes.items() if n > LINES], "landing_hour string, files long")
    part = F.pmod(F.xxhash64("value"), F.coalesce("files", F.lit(1)))
    tasks = min(sum(-(-n // LINES) for n in sizes.values()), int(spark.conf.get("spark.sql.shuffle.partitions")))
    (
        keyed.join(F.broadcast(files), "landing_hour", "left")
        .repartition(max(tasks, 1), "landing_hour", part)
        .select("value", "landing_hour")
        .write.option("compression", "gzip")
        .options(**layout.BESIDE)
        .partitionBy("landing_hour")
        .text(beside)
    )
    new: dict[date, dict[int, list[tuple[str, int, int]]]] = {}
    for path, size, modified in layout.globbed(spark, f"{beside}/landing_hour=*/part-*"):
        hour = layout.under(path, "landing_hour=").partition("=")[2][:10]
        if size:
            new.setdefault(date(int(hour[:4]), int(hour[4:6]), int(hour[6:8])), {}).setdefault(int(hour[8:]), []).append((path, size, modified))
    before = landed(spark, root, new)

    def commit(day: date) -> list[str]:
        return _land_day(spark, root, day, new[day], before.get(day, {}), mark)

    done = [f for own in layout.each(spark, commit, sorted(new)) for f in own]
    layout.delete_path(spark, beside)
    return done


def _land_day(spark: SparkSession, root: str, day: date, new: dict[int, list[tuple[str, int, int]]], before: dict[int, Hour], mark: str) -> list[str]:
    """Move one day's new files in, commit them, and delete what they replace."""
    folder, commits = layout.raw_day(root, day), _commits(root, day)
    if not layout.records(spark, commits):
        layout.put_record(spark, commits, _record(before))  # from now on only recorded files count
    there = {p.rpartition("/")[2] for p, _, _ in layout.children(spark, folder)}
    hours, files = dict(before), []
    for hour, own in sorted(new.items()):
        at = f"{folder}/hour={hour:02d}"
        held = layout.children(spark, at) if f"hour={hour:02d}" in there else []
        for path, size, _ in held:
            if not size:  # an empty file isn't a landed one, and would have its name
                layout.delete_path(spark, path)
        again = f".{mark}" if any(size for _, size, _ in held) else ""
        names = {}
        for k, (path, size, _) in enumerate(own):
            name = f"{day:%Y-%m-%d}-{hour}{f'.{k}' if k else ''}{again}.json.gz"
            layout.move(spark, path, f"{at}/{name}")
            names[name] = size
            files.append(f"{at}/{name}")
        hours[hour] = Hour(names, max(x[2] for x in own))
    layout.put_record(spark, commits, _record(hours))
    layout.drop_old_records(spark, commits)
    for hour in new:
        if f"hour={hour:02d}" in there:
            for path, _, _ in layout.children(spark, f"{folder}/hour={hour:02d}"):
                if path.rpartition("/")[2] not in hours[hour].files:
                    layout.delete_path(spark, path)
    return files


def land_missing(lines: DataFrame, root: str, window: Window) -> list[str]:
    """Land only those hours of the window (of days) that have no landed file; returns the files written."""
    have = landed_hours(lines.sparkSession, root, window.dates())
    hours = [f"{d:%Y%m%d}{h:02d}" for d, own in have.items() for h in own]  # 24 a day at most
    key = F.concat(*S.RAW_PARTITION_COLUMNS)
    inside = F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")]).between(F.lit(window.start), F.lit(window.end))
    return land_raw(lines.where(inside & ~key.isin(hours) if hours else inside), root)


def file_date() -> Column:
    """The date of the raw file, from its path."""
    return F.make_date("year", "month", "day")


def read_raw(
    spark: SparkSession,
    root: str,
    start: date | str | None = None,
    end: date | str | None = None,
    dates: list[date] | None = None,
    with_corrupt: bool = False,
    found: Landed | None = None,
) -> DataFrame:
    """Raw events (declared schema) with ``file_date``, of a window of days, of given days, or of all.

    Only landed hours' valid files are read: those of ``found``, if it is given
    (by :func:`landed`), else those of now.  ``with_corrupt`` adds the text of lines
    that are no JSON object.
    """
    schema = S.RAW_SCHEMA_WITH_PARTITIONS
    if with_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(S.CORRUPT_COLUMN, T.StringType())])
    days = dates if dates is not None else Window.of(start, end).dates() if start is not None and end is not None else None
    if found is None:
        found = landed(spark, root, days)
    found = {d: hours for d, hours in found.items() if days is None or d in days}
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", S.CORRUPT_COLUMN).option("basePath", root)
    if not found:
        return spark.createDataFrame([], schema).withColumn("file_date", file_date())
    df = reader.option("pathGlobFilter", "*.gz").json([layout.raw_day(root, d) for d in found])
    valid = {f"{layout.raw_day('', d)}/hour={h:02d}/{n}"[1:] for d, hours in found.items() for h, x in hours.items() for n in x.files}
    there = {layout.under(p, "year=") for p in df.inputFiles()}
    if there - valid:  # replaced files not deleted yet, or empty ones
        df = reader.json([f"{root.rstrip('/')}/{p}" for p in sorted(valid)])
    if gone := valid - there:
        raise FileNotFoundError(f"{len(gone)} landed file(s) are missing below {root}, the first is {min(gone)}")
    return df.where(in_dates(file_date(), start, end)).withColumn("file_date", file_date())


def malformed(raw: DataFrame) -> DataFrame:
    """(file_date, n_lines, n_malformed) of a scan with corrupt lines."""
    return raw.groupBy("file_date").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(no_json()).alias("n_malformed"))


def no_json() -> Column:
    """Whether a line, read with its corrupt text, is no JSON object."""
    return F.col(S.CORRUPT_COLUMN).isNotNull() & F.col("type").isNull()


def in_dates(c: Column, start: date | str | None, end: date | str | None) -> Column:
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(str(start)).cast("date"))
    if end is not None:
        cond = cond & (c <= F.lit(str(end)).cast("date"))
    return cond


def flatten_raw(raw: DataFrame) -> DataFrame:
    """Raw rows with nested fields as flat columns (for inspection)."""
    flat = [F.col(path).alias(path.removeprefix("payload.").replace(".", "_")) for path in S.RAW_PATHS.values()]
    return raw.select("created_at", *flat, *S.RAW_PARTITION_COLUMNS)
