"""Staging: required-key filter, column narrowing and full-row dedupe.

Semantics: a staged table holds each *distinct full row* of the source once.
Two rows with one event_id but different content both stay (that is what
the ``unique`` check then reports).  Counting ids, splitting by count, joining back and a
distinct union reduce to ``distinct``; the steps are there one by one for
inspection, and :func:`stage_events_stepwise` only to test that they agree.

Skew: ``distinct`` and per-id counts aggregate map-side before the shuffle,
so a hot event_id or repo costs at most one row per map task per distinct
value; the joins by id keep the rows of hot ids out of their shuffle; nothing
collects a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotrend import schema as S

HOT_IDS = 1000


def required_keys(source: DataFrame) -> DataFrame:
    """Drop rows lacking event_id, repo_id or event_ts; narrow to the staged
    columns, with event_date recomputed from event_ts."""
    return source.where(
        F.col("event_id").isNotNull() & F.col("repo_id").isNotNull() & F.col("event_ts").isNotNull()
    ).select(
        *[
            F.to_date("event_ts").alias("event_date") if c == "event_date" else F.col(c)
            for c in S.STAGED_COLUMNS
        ]
    )


def event_id_counts(staged_input: DataFrame) -> DataFrame:
    """(event_id, row_count) over the filtered rows."""
    return staged_input.groupBy("event_id").agg(F.count(F.lit(1)).alias("row_count"))


def unique_event_ids(staged_input: DataFrame) -> DataFrame:
    return event_id_counts(staged_input).where(F.col("row_count") == 1).select("event_id")


def duplicate_event_ids(staged_input: DataFrame) -> DataFrame:
    return event_id_counts(staged_input).where(F.col("row_count") > 1).select("event_id")


def _with_hot(staged_input: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of hot ids, the other rows): an id is hot with more than one in ``HOT_IDS`` of all rows.

    Fewer than ``HOT_IDS`` ids can be, so they are broadcast, and their rows stay
    where they are; a join by id would send them to one task, and AQE splits no
    join whose other side is an aggregate.
    """
    all_rows = counts.agg(F.sum("row_count").alias("n")).scalar()
    hot = F.broadcast(counts.where(F.col("row_count") * HOT_IDS > all_rows).where("row_count > 1").select("event_id"))
    return staged_input.join(hot, "event_id", "left_semi"), staged_input.join(hot, "event_id", "left_anti")


def _of_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the ids, each of which is there once.

    Not a left-semi join: that is pushed below a union that ``rows`` come from, and
    makes a join of each branch, all in one task, with two sorts and a count each.
    """
    return rows.join(ids, "event_id")


def non_duplicate_events(staged_input: DataFrame, split_hot: bool = True) -> DataFrame:
    """Rows whose event_id occurs once.

    Ids alone are counted (a hash aggregate, partial, so a hot id is one row a
    task); whole rows are shuffled once, for the join, those of hot ids
    not even that, and no row passes through a sort-based aggregate.  Without
    ``split_hot`` (rows in buckets by id have no such ids) all rows are joined.
    """
    counts = event_id_counts(staged_input)
    rows = _with_hot(staged_input, counts)[1] if split_hot else staged_input
    return _of_ids(rows, counts.where("row_count = 1").select("event_id")).select(*staged_input.columns)


def duplicate_events(staged_input: DataFrame, split_hot: bool = True) -> DataFrame:
    """Rows whose event_id occurs more than once (all of their copies).

    Rows of hot ids are found by a broadcast of those few ids, the others by a
    join with the ids that occur more than once.
    """
    counts = event_id_counts(staged_input)
    ids = counts.where("row_count > 1").select("event_id")
    if not split_hot:
        return _of_ids(staged_input, ids).select(*staged_input.columns)
    hot, rows = _with_hot(staged_input, counts)
    return _of_ids(rows, ids).select(*staged_input.columns).unionByName(hot.select(*staged_input.columns))


def dedup_duplicates(staged_input: DataFrame, split_hot: bool = True) -> DataFrame:
    """Distinct rows among the duplicated ids."""
    return duplicate_events(staged_input, split_hot).distinct()


def stage_events(source: DataFrame) -> DataFrame:
    """Staged events of one kind: required keys, narrowed columns, distinct."""
    return required_keys(source).distinct()


def stage_events_stepwise(source: DataFrame) -> DataFrame:
    """The step-by-step form (ids once ∪ distinct duplicated), for equivalence
    tests against :func:`stage_events`."""
    rows = required_keys(source)
    return non_duplicate_events(rows).unionByName(dedup_duplicates(rows)).distinct()
