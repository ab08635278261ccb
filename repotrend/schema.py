"""Schemas, column lists and kind constants for every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's (event types, table names,
# partition layout, intent labels).
WATCH_EVENT = "WatchEvent"
FORK_EVENT = "ForkEvent"
KIND_TO_EVENT_TYPE = {"watch": WATCH_EVENT, "fork": FORK_EVENT}
KIND_TO_SOURCE_TABLE = {"watch": "source_watch_events", "fork": "source_fork_events"}
RAW_PARTITION_COLUMNS = ["year", "month", "day", "hour"]
INTENT_TYPES = ["usage_driven", "interest_driven", "balanced"]
FACT_TABLE = "fct_repo_daily_watch_fork_metrics"
TOP_WATCH_TABLE = "marts_watch_top_repos_7d"
TOP_FORK_TABLE = "marts_fork_top_repos_7d"
RISING_TABLE = "marts_watch_rasing_repos_7d"  # spelling kept: readers query this name
INTENT_TABLE = "marts_repo_intent_classification"
STAGED_TABLES = {"watch": "stg_watch_events", "fork": "stg_fork_events"}

# Raw event as landed: one JSON object per line.  Declared, never inferred,
# so a day without ``org`` or ``payload.forkee`` still reads, and the scan
# materialises only these fields.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("public", T.BooleanType()),
        T.StructField(
            "actor",
            T.StructType([T.StructField("id", T.LongType()), T.StructField("login", T.StringType())]),
        ),
        T.StructField(
            "repo",
            T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]),
        ),
        T.StructField(
            "org",
            T.StructType([T.StructField("id", T.LongType()), T.StructField("login", T.StringType())]),
        ),
        T.StructField(
            "payload",
            T.StructType(
                [
                    T.StructField("action", T.StringType()),
                    T.StructField(
                        "forkee",
                        T.StructType(
                            [
                                T.StructField("id", T.LongType()),
                                T.StructField("full_name", T.StringType()),
                            ]
                        ),
                    ),
                ]
            ),
        ),
    ]
)

# Raw schema as read from the Hive-style landing root (partition columns
# filled in from the path), with the text of lines that are no JSON object.
CORRUPT_COLUMN = "_corrupt_record"
RAW_SCHEMA_WITH_PARTITIONS = T.StructType(
    RAW_SCHEMA.fields + [T.StructField(c, T.IntegerType()) for c in RAW_PARTITION_COLUMNS]
)

# The columns of each layer, and where each comes from in a raw
# event (event_ts, event_date and event_hour are made from ``created_at``).
SOURCE_COLUMNS = [
    "event_id", "event_type", "event_ts", "event_hour", "repo_id", "repo_name", "actor_id",
    "actor_login", "org_id", "org_login", "action", "is_public",
]
FORK_SOURCE_COLUMNS = [
    "event_id", "event_type", "event_ts", "event_hour", "repo_id", "repo_name", "actor_id",
    "actor_login", "org_id", "org_login", "action", "forkee_repo_id", "forkee_repo_name", "is_public",
]
WATCH_COLUMNS = [
    "event_id", "event_type", "event_ts", "event_date", "event_hour", "repo_id", "repo_name",
    "actor_id", "actor_login", "org_id", "org_login", "action", "is_public",
]
FORK_COLUMNS = [
    "event_id", "event_type", "event_ts", "event_date", "event_hour", "repo_id", "repo_name",
    "actor_id", "actor_login", "org_id", "org_login", "action", "forkee_repo_id", "forkee_repo_name",
    "is_public",
]
FORKEE_COLUMNS = ["forkee_repo_id", "forkee_repo_name"]
RAW_PATHS = {
    "event_id": "id",
    "event_type": "type",
    "repo_id": "repo.id",
    "repo_name": "repo.name",
    "actor_id": "actor.id",
    "actor_login": "actor.login",
    "org_id": "org.id",
    "org_login": "org.login",
    "action": "payload.action",
    "forkee_repo_id": "payload.forkee.id",
    "forkee_repo_name": "payload.forkee.full_name",
    "is_public": "public",
}

# Staged events have the watch columns for both kinds.  The curated table holds
# both kinds, partitioned by kind and the raw file's date; forkee columns are
# NULL for watch rows.
STAGED_COLUMNS = list(WATCH_COLUMNS)
CURATED_COLUMNS = FORK_COLUMNS
CURATED_PARTITION_COLUMNS = ["kind", "file_date"]
COLUMN_TYPES = {
    "event_id": T.StringType(), "event_type": T.StringType(), "event_ts": T.TimestampType(),
    "event_date": T.DateType(), "event_hour": T.IntegerType(), "repo_id": T.LongType(),
    "repo_name": T.StringType(), "actor_id": T.LongType(), "actor_login": T.StringType(),
    "org_id": T.LongType(), "org_login": T.StringType(), "action": T.StringType(),
    "forkee_repo_id": T.LongType(), "forkee_repo_name": T.StringType(), "is_public": T.BooleanType(),
    "kind": T.StringType(), "file_date": T.DateType(),
}


def struct_of(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, COLUMN_TYPES[c]) for c in columns])


CURATED_SCHEMA = struct_of(CURATED_COLUMNS + CURATED_PARTITION_COLUMNS)

FACT_KEYS = ["event_date", "repo_id", "repo_name"]
FACT_COLUMNS = FACT_KEYS + ["watch_events_cnt", "fork_events_cnt"]
REPO_KEYS = ["repo_id", "repo_name"]


def source_columns(kind: str) -> list[str]:
    return FORK_SOURCE_COLUMNS if check_kind(kind) == "fork" else SOURCE_COLUMNS


def check_kind(kind: str) -> str:
    if kind not in KIND_TO_EVENT_TYPE:
        raise ValueError(f"no such kind of event: {kind!r}")
    return kind
