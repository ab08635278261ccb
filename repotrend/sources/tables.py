"""Curated, source, fact and mart tables (Parquet folders, by name if wanted).

Curated events: one table for both kinds, partitioned by ``(kind,
file_date)`` where ``file_date`` is the raw file's date and ``event_date`` an
ordinary column.  Writing a set of dates replaces exactly their partitions; a
straggler row of D-1 in D's file lands in ``file_date=D`` and leaves D-1 alone.
New files are put beside the old ones; then one record a day (``_days``) names the
files that are its rows now, of both kinds, and the landed hours they were
extracted from; the old files go last.  Readers take the recorded files alone, so
rows, removed partitions and what is known to be extracted change together.

Whole tables are version folders (``v-…``) with records (``_versions``) that say
which of them are the table: a version is staged, may be checked, and is published
by its record.  The version before stays until the next one, so whoever reads it
isn't disturbed; an append is a version with one folder more.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date
from statistics import median

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from repotrend import schema as S
from repotrend.params import Window, as_date
from repotrend.sources import layout
from repotrend.sources.layout import delete_path, path_exists
from repotrend.sources.raw import in_dates

__all__ = ["delete_path", "path_exists"]

WRITE_TRUNCATE = "WRITE_TRUNCATE"
WRITE_APPEND = "WRITE_APPEND"
WRITE_EMPTY = "WRITE_EMPTY"
DISPOSITIONS = (WRITE_TRUNCATE, WRITE_APPEND, WRITE_EMPTY)
BUCKET_SKEW, BUCKET_LEAST = 5, 1 << 20  # a bucket's bytes against the median, or against so many if that is more

# day -> hour -> (files, bytes, last modification), as listed by raw.landed_hours
Landed = dict[date, dict[int, tuple[int, int, int]]]


# ---------------------------------------------------------------- curated

def _partition(root: str, kind: str, day: date) -> str:
    return f"{root.rstrip('/')}/kind={kind}/file_date={day.isoformat()}"


def _day_records(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/_days/file_date={day.isoformat()}"


@dataclass(frozen=True)
class CuratedDay:
    """A day's files of each kind (name: bytes), and the landed hours they were extracted from."""

    files: dict[str, dict[str, int]]
    hours: dict[int, tuple[int, int, int]]


def curated_days(spark: SparkSession, root: str, days: list[date]) -> dict[date, CuratedDay]:
    """The days' last records; days without one are left out."""
    found = layout.each(spark, lambda d: layout.last_record(spark, _day_records(root, d)), days)
    return {d: CuratedDay(r["files"], {int(h): tuple(x) for h, x in r["hours"].items()}) for d, r in zip(days, found, strict=True) if r}


def _curated_files(spark: SparkSession, root: str, day: date) -> dict[str, dict[str, int]]:
    """kind -> name -> bytes of what is in a day's partitions."""
    out = {}
    for kind in S.KIND_TO_EVENT_TYPE:
        out[kind] = {p.rpartition("/")[2]: n for p, n, _ in layout.children(spark, _partition(root, kind, day)) if p.endswith(".parquet")}
    return out


def write_curated(extracted: DataFrame, root: str, landed: Landed) -> set[tuple[str, date]]:
    """Replace the curated partitions of the landed days with ``extracted``.

    ``extracted`` must be what was read from those days.  A day of ``landed``
    that has no rows of a kind loses that kind's partition; days without landed
    hours can't be given, so history whose raw files are gone stays.  Returns the
    ``(kind, file_date)`` partitions written.  No shuffle: every raw hour file
    belongs to one file_date, so each scan task writes at most one file per kind.

    A day changes when its record is there; a write that breaks off before leaves
    it as it was, and one that breaks off later leaves old files for the next
    write of the day to delete.
    """
    if empty := [d for d, hours in landed.items() if not hours]:
        raise ValueError(f"no landed hours for {empty[0]}: its curated rows can't be replaced")
    spark = extracted.sparkSession
    days = sorted(landed)
    before = dict(zip(days, layout.each(spark, lambda d: _curated_files(spark, root, d), days), strict=True))
    known = curated_days(spark, root, days)
    for day in days:
        if day not in known:  # files of no record, if any, are the day until the new record is there
            layout.put_record(spark, _day_records(root, day), {"files": before[day], "hours": {}})
    obs = Observation("curated_partitions")
    key = F.concat_ws("|", F.col("kind"), F.col("file_date").cast("string"))
    (
        extracted.observe(obs, F.collect_set(key).alias("parts"))  # two a day at most
        .write.mode("append")
        .options(**layout.BESIDE)
        .partitionBy(*S.CURATED_PARTITION_COLUMNS)
        .parquet(root)
    )
    written = {(k, as_date(d)) for k, d in (p.split("|") for p in obs.get.get("parts") or [])}
    if strange := {d for _, d in written} - set(days):
        raise ValueError(f"rows of {min(strange)} were extracted, which isn't among the landed days")
    after = dict(zip(days, layout.each(spark, lambda d: _curated_files(spark, root, d), days), strict=True))
    new = {d: {k: {n: size for n, size in own.items() if n not in before[d][k]} for k, own in after[d].items()} for d in days}
    marks = {m[1] for d in days for own in new[d].values() for n in own if (m := re.match(r"part-\d+-([0-9a-f-]{36})", n))}
    if len(marks) > 1:
        raise RuntimeError(f"another write into {root} is under way")

    def commit(day: date) -> None:
        _commit_day(spark, root, day, new[day], landed[day])

    def clean(day: date) -> None:
        _delete_replaced(spark, root, day, before[day])

    layout.each(spark, commit, days)
    layout.each(spark, clean, days)
    return written


def _commit_day(spark: SparkSession, root: str, day: date, files: dict[str, dict[str, int]], hours: dict[int, tuple[int, int, int]]) -> None:
    layout.put_record(spark, _day_records(root, day), {"files": files, "hours": hours})
    layout.drop_old_records(spark, _day_records(root, day))


def _delete_replaced(spark: SparkSession, root: str, day: date, before: dict[str, dict[str, int]]) -> None:
    for kind, own in before.items():
        for name in own:
            delete_path(spark, f"{_partition(root, kind, day)}/{name}")


def pending_dates(spark: SparkSession, root: str, days: list[date], landed: Landed) -> list[date]:
    """The days of which a landed hour is not in the curated table as it is now, or that never were extracted.

    A day is done if it was extracted from just the hours that are landed now
    (the same files by size and time), or if its raw files are gone, and the
    partitions it then had are there.
    """
    known = curated_days(spark, root, days)

    def pending(day: date) -> bool:
        now = known.get(day)
        if now is None or not now.hours or (day in landed and landed[day] != now.hours):
            return True
        return not all(path_exists(spark, _partition(root, k, day)) for k, own in now.files.items() if own)

    return [d for d, late in zip(days, layout.each(spark, pending, days), strict=True) if late]


def _all_curated_days(spark: SparkSession, root: str) -> list[date]:
    """Every day with a partition or a record."""
    folders = [f"{root.rstrip('/')}/{x}" for x in [*(f"kind={k}" for k in S.KIND_TO_EVENT_TYPE), "_days"]]
    names = {p.rpartition("/file_date=")[2] for own in layout.each(spark, lambda f: layout.children(spark, f), folders) for p, _, _ in own if "/file_date=" in p}
    return sorted(date.fromisoformat(x) for x in names)


def read_curated(
    spark: SparkSession,
    root: str,
    kind: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """Curated rows, of one kind or both, of a window of file dates or all; only those folders are listed.

    Of a day with a record its files are read and no others; that one of them is
    gone is an error.  A day that only has partitions is read whole.
    """
    kinds = [S.check_kind(kind)] if kind is not None else list(S.KIND_TO_EVENT_TYPE)
    days = _all_curated_days(spark, root) if start is None or end is None else Window.of(start, end).dates()
    known = curated_days(spark, root, days)
    wanted = [(k, d) for k in kinds for d in days if d not in known or known[d].files.get(k)]
    folders = [_partition(root, k, d) for k, d in wanted]
    folders = [f for f, there in zip(folders, layout.each(spark, lambda f: path_exists(spark, f), folders), strict=True) if there]
    valid = {f"{_partition('', k, d)}/{n}"[1:] for k, d in wanted if d in known for n in known[d].files[k]}
    reader = spark.read.schema(S.CURATED_SCHEMA).option("basePath", root)
    df = reader.parquet(*folders) if folders else spark.createDataFrame([], S.CURATED_SCHEMA)
    there = {layout.under(p, "kind=") for p in df.inputFiles()}
    if gone := valid - there:
        raise FileNotFoundError(f"{len(gone)} curated file(s) are missing below {root}, the first is {min(gone)}: extract their days again")
    plain = {p for p in there if date.fromisoformat(p.split("file_date=")[1][:10]) not in known}
    if there - valid - plain:  # replaced files that aren't deleted yet
        df = reader.parquet(*[f"{root.rstrip('/')}/{p}" for p in sorted(valid | plain)])
    return df.where(in_dates(F.col("file_date"), start, end))


# --------------------------------------------------------- whole tables

@dataclass(frozen=True)
class Load:
    """A folder of a version: its rows, the id of the load that brought them, and the catalog table that knows its buckets, if there are such."""

    folder: str
    rows: int
    load_id: str | None = None
    table: str | None = None


@dataclass(frozen=True)
class Version:
    loads: tuple[Load, ...] = field(default_factory=tuple)

    @property
    def rows(self) -> int:
        return sum(x.rows for x in self.loads)


def _version_records(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def _version(record: dict | None) -> Version | None:
    return None if record is None else Version(tuple(Load(*x) for x in record["loads"]))


def current(spark: SparkSession, root: str) -> Version | None:
    """The published version of a table, or None."""
    return _version(layout.last_record(spark, _version_records(root)))


def stage(df: DataFrame, root: str, partition_by: tuple[str, ...] = (), load_id: str | None = None) -> Load:
    """Write ``df`` into a folder of the table that no reader looks at yet."""
    folder, obs = f"v-{layout.fresh_id()}", Observation("rows")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.options(**layout.BESIDE).partitionBy(*partition_by).parquet(f"{root.rstrip('/')}/{folder}")
    return Load(folder, int(obs.get["n"]), load_id)


def stage_bucketed(df: DataFrame, root: str, database: str, name: str, by: str, load_id: str | None = None, dealt: bool = False) -> Load:
    """:func:`stage` in buckets by a column, which aggregates and joins on it then need no exchange for.

    ``dealt`` says that ``df`` is dealt by the column as it is.  A bucket is read by
    one task, so buckets are given up where one is over ``BUCKET_SKEW`` times the
    median (a key that holds much of the rows): such a version is read evenly
    and shuffled after partial aggregation, as any table.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder, obs = f"v-{layout.fresh_id()}", Observation("rows")
    table = f"{database}.{name}__{folder[2:]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    rows = df.observe(obs, F.count(F.lit(1)).alias("n"))
    if not dealt:  # by bucket, large ones split over several tasks
        own = "bucket_of_" + "_".join(df.columns)
        rows = rows.withColumn(own, F.pmod(F.hash(by), F.lit(buckets))).hint("rebalance", own).drop(own)
    rows.write.bucketBy(buckets, by).sortBy(by).option("path", f"{root.rstrip('/')}/{folder}").saveAsTable(table)
    sizes = [0] * buckets
    for path, size, _ in layout.children(spark, f"{root.rstrip('/')}/{folder}"):
        if m := re.search(r"_(\d{5})\.c\d+\.", path):
            sizes[int(m[1])] += size
    if max(sizes) > BUCKET_SKEW * max(median(sizes), BUCKET_LEAST):
        spark.sql(f"DROP TABLE {table}")  # the files stay
        table = None
    return Load(folder, int(obs.get["n"]), load_id, table)


def publish(spark: SparkSession, root: str, version: Version) -> None:
    """Make the staged folders of ``version`` the table; folders of neither it nor the one before are deleted after."""
    layout.put_record(spark, _version_records(root), {"loads": [[x.folder, x.rows, x.load_id, x.table] for x in version.loads]})
    layout.drop_old_records(spark, _version_records(root))


def vacuum(spark: SparkSession, root: str) -> None:
    """Delete version folders that no kept record names: those before the last version but one, and what was never published.

    Only for when nothing else writes the table.
    """
    kept = {x.folder for r in layout.records(spark, _version_records(root)) for x in _version(layout.read_record(spark, r)).loads}
    for path, _, _ in layout.children(spark, root):
        name = path.rpartition("/")[2]
        if name.startswith("v-") and name not in kept:
            delete_path(spark, path)
    if tables := [x.table for r in layout.records(spark, _version_records(root)) for x in _version(layout.read_record(spark, r)).loads if x.table]:
        database, _, name = tables[-1].partition(".")
        for t in spark.catalog.listTables(database, name.rpartition("__")[0] + "__*"):
            if f"{database}.{t.name}" not in tables:
                spark.sql(f"DROP TABLE IF EXISTS {database}.{t.name}")


def version_paths(root: str, version: Version) -> list[str]:
    return [f"{root.rstrip('/')}/{x.folder}" for x in version.loads]


def read_version(spark: SparkSession, root: str, version: Version) -> DataFrame:
    """The rows of a version, whether it is published or not."""
    parts = [spark.table(x.table) if x.table else spark.read.parquet(f"{root.rstrip('/')}/{x.folder}") for x in version.loads]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The published rows of a table."""
    version = current(spark, root)
    if version is None:
        raise FileNotFoundError(f"{root} has no published version")
    return read_version(spark, root, version)


def replace_table(df: DataFrame, target: str, partition_by: tuple[str, ...] = (), least: int = 0) -> int:
    """Publish ``df`` as the whole table; returns its rows.

    With fewer rows than ``least`` the old table stays and 0 is returned.
    """
    spark = df.sparkSession
    load = stage(df, target, partition_by)
    if load.rows >= least:
        publish(spark, target, Version((load,)))
    vacuum(spark, target)
    return load.rows if load.rows >= least else 0


def write_table(df: DataFrame, root: str) -> None:
    """Full rebuild of an unpartitioned table."""
    replace_table(df, root)


def register(spark: SparkSession, database: str, name: str, root: str, version: Version) -> str:
    """Make the rows of a version known by name, in one step in place of what had the name; returns the name.

    The name is a view of its folders: replacing a view is one change in the
    catalog, whereas the partitions of a catalog table have a place each.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if any(t.name == name and t.tableType != "VIEW" for t in spark.catalog.listTables(database, name)):
        spark.sql(f"DROP TABLE `{database}`.`{name}`")
    rows = " UNION ALL ".join(f"SELECT * FROM {x.table or f'parquet.`{p}`'}" for x, p in zip(version.loads, version_paths(root, version), strict=True))
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {rows}")
    return f"{database}.{name}"


# ----------------------------------------------------------------- source

def load_source(
    spark: SparkSession,
    curated_root: str,
    kind: str,
    start: date | str,
    end: date | str,
    target: str,
    disposition: str = WRITE_TRUNCATE,
    load_id: str | None = None,
) -> int:
    """Load one kind's curated rows of ``[start, end]`` into a source table.

    Dispositions: WRITE_TRUNCATE replaces the table, WRITE_APPEND adds to
    it, WRITE_EMPTY writes only when the table is absent or has no rows.
    Raises when the range holds no rows, with the table as it was.  Rows are
    counted while they are written.  Returns the table's row count.

    A load with an id is in the table at most once: one that is repeated, after a
    lost driver say, adds nothing when the id is among the table's loads.
    """
    version = stage_source(spark, curated_root, kind, start, end, target, disposition, load_id)
    if version != current(spark, target):
        publish(spark, target, version)
    vacuum(spark, target)
    return version.rows


def stage_source(
    spark: SparkSession, curated_root: str, kind: str, start: date | str, end: date | str, target: str,
    disposition: str = WRITE_TRUNCATE, load_id: str | None = None, database: str | None = None,
) -> Version:
    """What :func:`load_source` publishes: the version that the table is to have; with a database, in buckets by event id."""
    if disposition not in DISPOSITIONS:
        raise ValueError(f"no such write disposition: {disposition!r}")
    now = current(spark, target) or Version()
    if load_id is not None and any(x.load_id == load_id for x in now.loads):
        return now
    if disposition == WRITE_EMPTY and now.rows:
        raise ValueError(f"{target} has {now.rows} rows, so WRITE_EMPTY can't load it")
    rows = read_curated(spark, curated_root, kind, *_bounds(start, end)).select(*S.source_columns(kind))
    if database:
        load = stage_bucketed(rows, target, database, S.KIND_TO_SOURCE_TABLE[kind], "event_id", load_id)
    else:
        load = stage(rows, target, load_id=load_id)
    if not load.rows:
        vacuum(spark, target)
        raise FileNotFoundError(f"{curated_root} has no {kind} rows from {start} to {end}; extract them first")
    return Version((*[x for x in now.loads if x.rows], load) if disposition == WRITE_APPEND else (load,))


def _bounds(start: date | str, end: date | str) -> tuple[date, date]:
    window = Window.of(start, end)
    return window.start, window.end


def create_empty(spark: SparkSession, kind: str, target: str) -> None:
    """An empty source table of ``kind`` (schema only)."""
    replace_table(spark.createDataFrame([], S.struct_of(S.source_columns(kind))), target)


# ------------------------------------------------------------------- fact

def clustered_fact(fact: DataFrame) -> DataFrame:
    """The fact in files of disjoint ranges of (event_date, repo_id), sorted inside.

    Bounds are sampled, so a large day is split over several files by repo, and a
    repo is in one or two files of it; AQE merges small neighbouring ranges.
    """
    return fact.repartitionByRange("event_date", "repo_id").sortWithinPartitions("event_date", "repo_id")


def write_fact(fact: DataFrame, root: str) -> None:
    """Full rebuild of the fact, partitioned by event_date and clustered by repo_id within and across files."""
    replace_table(clustered_fact(fact), root, ("event_date",))


def read_fact(
    spark: SparkSession, root: str, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    df = read_table(spark, root)
    if start is not None or end is not None:
        df = df.where(in_dates(F.col("event_date"), start, end))
    return df.select(*S.FACT_COLUMNS)
