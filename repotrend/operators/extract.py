"""Extraction: raw events -> flat watch / fork event frames.

``event_ts`` comes from ``created_at`` (not from the file's path), so a row
of day D-1 found in day D's file keeps event_date D-1 while its file_date
stays D.  ``try_to_timestamp`` turns a bad timestamp into NULL (dropped by
staging) instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotrend import schema as S


def relevant_events(raw: DataFrame) -> DataFrame:
    """Only the two event types the pipeline keeps (pushed into the scan)."""
    return raw.where(F.col("type").isin(S.WATCH_EVENT, S.FORK_EVENT))


def _fields(columns: list[str]) -> dict[str, Column]:
    ts = F.try_to_timestamp(F.col("created_at"))
    timed = {"event_ts": ts, "event_date": F.to_date(ts), "event_hour": F.hour(ts)}
    return {c: timed[c] if c in timed else F.col(S.RAW_PATHS[c]) for c in columns}


def build_watch(raw: DataFrame) -> DataFrame:
    """WatchEvent rows as the 13 watch columns."""
    return raw.where(F.col("type") == S.WATCH_EVENT).select(*[f.alias(c) for c, f in _fields(S.WATCH_COLUMNS).items()])


def build_fork(raw: DataFrame) -> DataFrame:
    """ForkEvent rows as the 15 fork columns."""
    return raw.where(F.col("type") == S.FORK_EVENT).select(*[f.alias(c) for c, f in _fields(S.FORK_COLUMNS).items()])


def extract_events(raw: DataFrame) -> DataFrame:
    """Both kinds in one projection over one scan: ``kind``, ``file_date`` and
    the 15 curated columns (forkee NULL for watch rows)."""
    f = _fields(S.CURATED_COLUMNS)
    is_fork = F.col("type") == S.FORK_EVENT
    for c in S.FORKEE_COLUMNS:
        f[c] = F.when(is_fork, f[c])
    kind = F.when(is_fork, F.lit("fork")).otherwise(F.lit("watch"))
    return relevant_events(raw).select(
        kind.alias("kind"), F.col("file_date"), *[f[c].alias(c) for c in S.CURATED_COLUMNS]
    )
