"""Marts over the daily fact, for one anchor date.

All windows are half-open and end before the anchor day (a partial day):
current week ``[anchor-7, anchor)``, previous week ``[anchor-14, anchor-7)``.
On a fact partitioned by ``event_date`` those predicates prune partitions.

Aggregations are by (repo_id, repo_name) and partial, so a hot repository
costs one pre-aggregated row per map task.  Top-k plans as
``TakeOrderedAndProject`` (per-partition top k, then merge), never a full
sort.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotrend import schema as S
from repotrend.functions import countif, in_trailing_window, null_if_zero, safe_divide, smoothed_ratio

WEEK = 7


def weekly_totals(
    fact: DataFrame,
    anchor: date | str,
    measures: dict[str, str],
    start_days: int = WEEK,
    end_days: int = 0,
) -> DataFrame:
    """Per-repo sums of fact counts over ``[anchor-start_days, anchor-end_days)``.

    ``measures`` maps output name -> fact column.
    """
    return (
        fact.where(in_trailing_window("event_date", anchor, start_days, end_days))
        .groupBy(*S.REPO_KEYS)
        .agg(*[F.sum(src).cast("bigint").alias(out) for out, src in measures.items()])
    )


def weekly_watch(fact: DataFrame, anchor: date | str) -> DataFrame:
    return weekly_totals(fact, anchor, {"weekly_watch_count": "watch_events_cnt"})


def weekly_fork(fact: DataFrame, anchor: date | str) -> DataFrame:
    return weekly_totals(fact, anchor, {"weekly_fork_count": "fork_events_cnt"})


def weekly_watch_fork(fact: DataFrame, anchor: date | str) -> DataFrame:
    return weekly_totals(
        fact,
        anchor,
        {"weekly_watch_count": "watch_events_cnt", "weekly_fork_count": "fork_events_cnt"},
    )


def prev_week_watch(fact: DataFrame, anchor: date | str) -> DataFrame:
    return weekly_totals(
        fact, anchor, {"prev_week_watch_count": "watch_events_cnt"}, start_days=2 * WEEK, end_days=WEEK
    )


def top_repos(weekly: DataFrame, measure: str, k: int = 10) -> DataFrame:
    """The ``k`` repos with the largest ``measure``.

    Ties are broken by repo_id, then repo_name (NULL first) so the result is
    deterministic; the source order leaves them undefined.
    """
    return weekly.orderBy(
        F.col(measure).desc(), F.col("repo_id").asc_nulls_first(), F.col("repo_name").asc_nulls_first()
    ).limit(k)


def top_watched(fact: DataFrame, anchor: date | str, k: int = 10) -> DataFrame:
    return top_repos(weekly_watch(fact, anchor), "weekly_watch_count", k)


def top_forked(fact: DataFrame, anchor: date | str, k: int = 10) -> DataFrame:
    return top_repos(weekly_fork(fact, anchor), "weekly_fork_count", k)


def _rising_columns(cur: F.Column, prev: F.Column) -> list:
    return [
        F.col("repo_id"),
        F.col("repo_name"),
        cur.cast("bigint").alias("current_week_watch_count"),
        prev.cast("bigint").alias("prev_week_watch_count"),
        (cur - prev).cast("bigint").alias("watch_count_delta"),
        smoothed_ratio(cur, prev).alias("watch_growth_ratio"),
    ]


def _rising_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("watch_count_delta").desc(), F.col("current_week_watch_count").desc())


def rising_repos_join(fact: DataFrame, anchor: date | str, min_count: int = 20) -> DataFrame:
    """Current-week repos left-joined to their previous week (plain '=' on
    repo_id and repo_name, so a NULL name finds no previous week)."""
    cur = weekly_totals(fact, anchor, {"_cur": "watch_events_cnt"})
    prev = weekly_totals(fact, anchor, {"_prev": "watch_events_cnt"}, 2 * WEEK, WEEK)
    joined = cur.join(prev, on=S.REPO_KEYS, how="left")
    out = joined.select(*_rising_columns(F.col("_cur"), F.coalesce(F.col("_prev"), F.lit(0))))
    return _rising_order(out.where(F.col("current_week_watch_count") >= min_count))


def week_frame(fact: DataFrame, anchor: date | str) -> DataFrame:
    """Per repo, the sums that all marts of an anchor are made of, in one pass over its two weeks.

    cur_watch, cur_fork and prev_watch; cur_rows is the number of the repo's
    fact rows in the current week.
    """
    cur, prev = in_trailing_window("event_date", anchor, WEEK), in_trailing_window("event_date", anchor, 2 * WEEK, WEEK)
    return fact.where(in_trailing_window("event_date", anchor, 2 * WEEK)).groupBy(*S.REPO_KEYS).agg(
        F.sum(F.when(cur, F.col("watch_events_cnt"))).cast("bigint").alias("cur_watch"),
        F.sum(F.when(cur, F.col("fork_events_cnt"))).cast("bigint").alias("cur_fork"),
        F.sum(F.when(prev, F.col("watch_events_cnt"))).cast("bigint").alias("prev_watch"),
        countif(cur).alias("cur_rows"),
    )


def marts_of(weeks: DataFrame) -> dict[str, DataFrame]:
    """The four marts of a :func:`week_frame`; the rising one without an order."""
    now = weeks.where("cur_rows > 0").select(
        *S.REPO_KEYS, F.col("cur_watch").alias("weekly_watch_count"), F.col("cur_fork").alias("weekly_fork_count"))
    return {
        S.TOP_WATCH_TABLE: top_repos(now.drop("weekly_fork_count"), "weekly_watch_count"),
        S.TOP_FORK_TABLE: top_repos(now.drop("weekly_watch_count"), "weekly_fork_count"),
        S.RISING_TABLE: _rising(weeks),
        S.INTENT_TABLE: intent_rates(repo_intent(repo_activity(now))),
    }


def _rising(weeks: DataFrame, min_count: int = 20) -> DataFrame:
    null_key = F.col("repo_id").isNull() | F.col("repo_name").isNull()
    prev = F.when(null_key, F.lit(0)).otherwise(F.coalesce(F.col("prev_watch"), F.lit(0)))
    cur = F.coalesce(F.col("cur_watch"), F.lit(0))
    return weeks.where("cur_rows > 0").select(*_rising_columns(cur, prev)).where(F.col("current_week_watch_count") >= min_count)


def rising_repos(fact: DataFrame, anchor: date | str, min_count: int = 20) -> DataFrame:
    """Week-over-week watch change for repos with ``min_count``+ watches this week.

    One pass over ``[anchor-14, anchor)`` with two conditional sums instead of
    two aggregates and a join.  Equal to :func:`rising_repos_join`: repos
    without a current-week row are dropped, and a NULL key gets previous 0
    (the join's '=' never matches NULL).  Decliners are kept.
    """
    return _rising_order(_rising(week_frame(fact, anchor), min_count))


def repo_activity(weekly_wf: DataFrame, threshold: int = 20) -> DataFrame:
    """'low_signal' when both weekly counts are below ``threshold``, else 'active'."""
    low = (F.col("weekly_watch_count") < threshold) & (F.col("weekly_fork_count") < threshold)
    return weekly_wf.select(
        *S.REPO_KEYS,
        "weekly_watch_count",
        "weekly_fork_count",
        F.when(low, F.lit("low_signal")).otherwise(F.lit("active")).alias("activity_label"),
    )


def repo_intent(activity: DataFrame, hi: float = 1.2, lo: float = 0.5) -> DataFrame:
    """Intent class of each active repo by its fork-to-watch ratio.

    Zero watches make the ratio NULL, which falls through to 'balanced'.
    """
    ratio = safe_divide("weekly_fork_count", null_if_zero("weekly_watch_count"))
    return activity.where(F.col("activity_label") == "active").select(
        *S.REPO_KEYS,
        "weekly_watch_count",
        "weekly_fork_count",
        F.when(ratio >= F.lit(float(hi)), F.lit("usage_driven"))
        .when(ratio <= F.lit(float(lo)), F.lit("interest_driven"))
        .otherwise(F.lit("balanced"))
        .alias("repo_intent_type"),
    )


def intent_rates(intent: DataFrame) -> DataFrame:
    """Share of each intent class among active repos: always three rows,
    rate NULL when there is no active repo.  One global aggregate."""
    counts = intent.agg(
        F.count(F.lit(1)).alias("_n"),
        *[countif(F.col("repo_intent_type") == t).alias(f"_{t}") for t in S.INTENT_TYPES],
    )
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("intent_type"), safe_divide(f"_{t}", "_n").alias("rate"))
            for t in S.INTENT_TYPES
        ]
    )
    return counts.select(F.inline(rows))


def intent_rates_for(fact: DataFrame, anchor: date | str, threshold: int = 20,
                     hi: float = 1.2, lo: float = 0.5) -> DataFrame:
    return intent_rates(repo_intent(repo_activity(weekly_watch_fork(fact, anchor), threshold), hi, lo))
