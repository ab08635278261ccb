"""Folders of the landing root and of tables, by the file system's own listing, and small commit records.

A window is looked up folder by folder (a day is one folder name, a few levels
deep), so a read lists what it needs and not everything ever landed.

A record is a small JSON file in a folder of records, numbered upwards.  It is
written under another name and moved to its own, so it is there whole or not at
all, and no record is ever written over: whoever reads the folder sees the last
one that was completed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from weakref import WeakKeyDictionary

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

THREADS = 16  # calls to the file system at a time
KEPT_RECORDS = 2
# Of writes that a record commits afterwards: tasks move their files themselves, the driver needn't, file by file.
BESIDE = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


_HADOOP: WeakKeyDictionary = WeakKeyDictionary()  # by session: the class of paths, and the configuration


def _at(spark: SparkSession, path: str):
    if spark not in _HADOOP:
        _HADOOP[spark] = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    make, conf = _HADOOP[spark]
    found = make(path)
    return found, found.getFileSystem(conf)


def path_exists(spark: SparkSession, path: str) -> bool:
    at, fs = _at(spark, path)
    return bool(fs.exists(at))


def delete_path(spark: SparkSession, path: str) -> bool:
    at, fs = _at(spark, path)
    return bool(fs.delete(at, True))


def children(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of what is in a folder, by name; none if it doesn't exist."""
    at, fs = _at(spark, path)
    if not fs.exists(at):
        return []
    return sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(at))


def move(spark: SparkSession, source: str, target: str) -> None:
    at, fs = _at(spark, source)
    to, _ = _at(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"can't move {source} to {target}")


def each(spark: SparkSession, function: Callable, items: Iterable) -> list:
    """``function(item)`` of each item, several at a time; the first failure is raised when all are through."""
    items = list(items)
    if len(items) < 2:
        return [function(x) for x in items]
    with ThreadPoolExecutor(min(THREADS, len(items))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(function), items))


def fresh_id() -> str:
    return uuid.uuid4().hex[:12]


# ---------------------------------------------------------------- records

def put_record(spark: SparkSession, folder: str, content: dict) -> str:
    """Write the next record of a folder of records; returns its path."""
    names = [p.rpartition("/")[2] for p, _, _ in children(spark, folder)]
    last = max((int(n[1:13]) for n in names if n.startswith("_")), default=-1)
    name = f"_{last + 1:012d}-{fresh_id()}"
    at, fs = _at(spark, f"{folder}/.{name}")
    out = fs.create(at, True)
    try:
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        out.close()
    move(spark, f"{folder}/.{name}", f"{folder}/{name}")
    return f"{folder}/{name}"


def records(spark: SparkSession, folder: str) -> list[str]:
    """The paths of a folder's records, the first to the last."""
    return [p for p, _, _ in children(spark, folder) if p.rpartition("/")[2].startswith("_")]


def read_record(spark: SparkSession, path: str) -> dict:
    at, fs = _at(spark, path)
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def last_record(spark: SparkSession, folder: str) -> dict | None:
    """The last completed record, or None."""
    found = records(spark, folder)
    return read_record(spark, found[-1]) if found else None


def drop_old_records(spark: SparkSession, folder: str) -> None:
    for path in records(spark, folder)[:-KEPT_RECORDS]:
        delete_path(spark, path)


# ------------------------------------------------------------------ files

def under(path: str, first: str) -> str:
    """What of a listed path comes from the component that begins with ``first``."""
    return path[path.index(f"/{first}") + 1 :]


def globbed(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time in ms) of the files that a pattern matches, listed by the driver."""
    at, fs = _at(spark, pattern)
    return sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.globStatus(at) or [])


def listed(spark: SparkSession, folders: list[str], names: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time in ms) of the files below the folders, listed as a Spark job."""
    if not folders:
        return []
    found = spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", "true").load(folders)
    return sorted(tuple(r) for r in found.selectExpr("path", "length", "unix_millis(modificationTime)").collect())


def raw_day(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/year={day:%Y}/month={day:%m}/day={day:%d}"


def raw_days(spark: SparkSession, root: str, days: Iterable[date]) -> list[date]:
    """The days that have a folder."""
    days = list(days)
    return [d for d, there in zip(days, each(spark, lambda d: path_exists(spark, raw_day(root, d)), days), strict=True) if there]


def all_raw_days(spark: SparkSession, root: str) -> list[date]:
    """Every day that has a folder."""
    at, fs = _at(spark, f"{root.rstrip('/')}/year=*/month=*/day=*")
    found = [s.getPath().toString() for s in fs.globStatus(at) or []]
    parts = [[x.partition("=")[2] for x in under(p, "year=").split("/")] for p in found]
    return sorted(date(*map(int, p)) for p in parts if all(x.isdigit() for x in p))
