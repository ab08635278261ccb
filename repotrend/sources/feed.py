"""Binding of the generic ``events`` table to the watch/fork event feed.

The test data has no code-hosting events; the query below (fixed text,
shared verbatim with the DuckDB oracle) reshapes ``events`` into rows with
the source-table columns, for every kind plus noise, with exact copies,
same-id conflicts, NULL ids/repos/names, a rename, a new repo, a fork-only
repo and fork-/watch-heavy repos.  It is a plain Spark SQL plan over the
``events`` Parquet, so its work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotrend import schema as S

# Fixed text: must stay identical in Spark SQL and DuckDB.
FEED_SQL = """with base as (
  select event_id, ts, user_id, user_id % 20 as rk,
    case when event_type = 'view' and user_id % 20 <> 19
              and (user_id % 20 <> 7 or ts >= timestamp '2024-01-23 00:00:00') then 'WatchEvent'
         when event_type = 'purchase' and (user_id % 20 % 5 <> 0 or event_id % 3 = 0) then 'ForkEvent'
         when event_type = 'click' and user_id % 20 % 5 in (1, 4) then 'ForkEvent'
         else 'PushEvent' end as etype
  from events),
shaped as (
  select case when event_id % 401 = 0 then null else cast(event_id as string) end as event_id,
    etype as event_type, ts as event_ts, cast(extract(hour from ts) as int) as event_hour,
    case when event_id % 97 = 0 then null else rk end as repo_id,
    case when event_id % 37 = 0 then null
         when rk = 3 and ts < timestamp '2024-01-20 00:00:00' then 'owner3/old3'
         else concat('owner', cast(rk % 5 as string), '/repo', cast(rk as string)) end as repo_name,
    user_id as actor_id, concat('user', cast(user_id as string)) as actor_login,
    case when user_id % 3 = 0 then user_id % 7 end as org_id,
    case when user_id % 3 = 0 then concat('org', cast(user_id % 7 as string)) end as org_login,
    case when etype = 'WatchEvent' then 'started' end as action, true as is_public, event_id as k
  from base)
select event_id, event_type, event_ts, event_hour, repo_id, repo_name, actor_id, actor_login,
       org_id, org_login, action, is_public from shaped
union all
select event_id, event_type, event_ts, event_hour, repo_id, repo_name, actor_id, actor_login,
       org_id, org_login, action, is_public from shaped where k % 10 = 0
union all
select event_id, event_type, event_ts, event_hour, repo_id, repo_name, actor_id, actor_login,
       org_id, org_login, 'other', is_public from shaped where k % 50 = 0"""

# Fixed text: the feed restricted to rows that pass every data-quality gate.
CLEAN_FILTER_SQL = (
    "event_id is not null and repo_name is not null and coalesce(action, '') <> 'other'"
)

# Fixed text: a feed of the same columns with about as many repositories and event ids
# as rows, but for one repository and one id that a third of the rows have each.
SKEWED_FEED_SQL = """with base as (
  select event_id, ts, user_id,
    case event_type when 'view' then 'WatchEvent' when 'purchase' then 'ForkEvent' else 'PushEvent' end as etype,
    case when event_id % 3 = 1 then 0 else event_id end as repo
  from events),
shaped as (
  select case when event_id % 3 = 2 then 'hot' else cast(event_id as string) end as event_id,
    etype as event_type, ts as event_ts, cast(extract(hour from ts) as int) as event_hour, repo as repo_id,
    concat('owner/repo', cast(repo as string)) as repo_name, user_id as actor_id, concat('user', cast(user_id as string)) as actor_login,
    user_id % 7 as org_id, concat('org', cast(user_id % 7 as string)) as org_login,
    case when etype = 'WatchEvent' then 'started' end as action, true as is_public, event_id as k
  from base)
select event_id, event_type, event_ts, event_hour, repo_id, repo_name, actor_id, actor_login,
       org_id, org_login, action, is_public from shaped
union all
select event_id, event_type, event_ts, event_hour, repo_id, repo_name, actor_id, actor_login,
       org_id, org_login, action, is_public from shaped where k % 10 = 0"""

# Fixed text: fork-only columns derived from the feed.
FORKEE_ID_SQL = "1000000 + repo_id"
FORKEE_NAME_SQL = "concat(actor_login, '/fork')"

# Anchor of the fixture data (30 whole days, 2024-01-01 .. 2024-01-30).
FIXTURE_ANCHOR = "2024-01-30"

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_FEED_COLUMNS = [
    "event_id", "event_type", "event_ts", "event_hour", "repo_id", "repo_name", "actor_id",
    "actor_login", "org_id", "org_login", "action", "is_public",
]


def feed(spark: SparkSession, sf_dir: str, clean: bool = False, text: str = FEED_SQL) -> DataFrame:
    """All feed rows (every kind).  ``event_ts`` is an instant (UTC).

    The fixture's ts is a naive timestamp; the pipeline works on instants,
    and with the session pinned to UTC the cast keeps every value.  Built as
    one SQL statement around the fixed feed text (one analysis pass).
    """
    cols = ", ".join(
        "cast(event_ts as timestamp) as event_ts" if c == "event_ts" else c for c in _FEED_COLUMNS
    )
    where = f" where {CLEAN_FILTER_SQL}" if clean else ""
    # The table is passed in, so no view of the caller's is replaced.
    text = text.replace("from events)", "from {events})")
    return spark.sql(f"select {cols} from (\n{text}\n) feed{where}", events=read_table(spark, sf_dir, "events"))


def source_events(feed_df: DataFrame, kind: str) -> DataFrame:
    """Rows of one kind with the source-table columns of that kind."""
    S.check_kind(kind)
    extra = {
        "forkee_repo_id": F.expr(FORKEE_ID_SQL).cast("bigint").alias("forkee_repo_id"),
        "forkee_repo_name": F.expr(FORKEE_NAME_SQL).alias("forkee_repo_name"),
    }
    return feed_df.where(F.col("event_type") == S.KIND_TO_EVENT_TYPE[kind]).select(
        *[extra.get(c, F.col(c)) for c in S.source_columns(kind)]
    )


def with_forkee(feed_df: DataFrame) -> DataFrame:
    """Feed rows with the fork-only columns (NULL on other kinds)."""
    is_fork = F.col("event_type") == S.FORK_EVENT
    return feed_df.withColumns(
        {
            "forkee_repo_id": F.when(is_fork, F.expr(FORKEE_ID_SQL).cast("bigint")),
            "forkee_repo_name": F.when(is_fork, F.expr(FORKEE_NAME_SQL)),
        }
    )


def sources(spark: SparkSession, sf_dir: str, clean: bool = False) -> dict[str, DataFrame]:
    f = feed(spark, sf_dir, clean=clean)
    return {kind: source_events(f, kind) for kind in S.KIND_TO_EVENT_TYPE}
