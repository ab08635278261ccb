"""Hand-made rows for golden tests."""

from datetime import datetime

from pyspark.sql import types as T

from repotrend import schema as S

SOURCE_TYPES = {
    "event_id": T.StringType(), "event_type": T.StringType(), "event_ts": T.TimestampType(),
    "event_hour": T.IntegerType(), "repo_id": T.LongType(), "repo_name": T.StringType(),
    "actor_id": T.LongType(), "actor_login": T.StringType(), "org_id": T.LongType(),
    "org_login": T.StringType(), "action": T.StringType(), "forkee_repo_id": T.LongType(),
    "forkee_repo_name": T.StringType(), "is_public": T.BooleanType(),
}


def source_schema(kind="watch"):
    return T.StructType([T.StructField(c, SOURCE_TYPES[c]) for c in S.source_columns(kind)])


def ev(event_id, ts, repo_id, repo_name, kind="watch", actor=1, action=None):
    """One source row.  ``ts`` is 'YYYY-MM-DD HH:MM:SS' (UTC)."""
    t = datetime.fromisoformat(ts)
    etype = S.KIND_TO_EVENT_TYPE[kind]
    row = {
        "event_id": event_id, "event_type": etype, "event_ts": t, "event_hour": t.hour,
        "repo_id": repo_id, "repo_name": repo_name, "actor_id": actor,
        "actor_login": f"user{actor}", "org_id": None, "org_login": None,
        "action": action if action is not None else ("started" if kind == "watch" else None),
        "forkee_repo_id": None if repo_id is None else 1000000 + repo_id,
        "forkee_repo_name": f"user{actor}/fork", "is_public": True,
    }
    return tuple(row[c] for c in S.source_columns(kind))


def frame(spark, rows, kind="watch"):
    return spark.createDataFrame(rows, source_schema(kind))


FACT_SCHEMA = T.StructType([
    T.StructField("event_date", T.DateType()), T.StructField("repo_id", T.LongType()),
    T.StructField("repo_name", T.StringType()), T.StructField("watch_events_cnt", T.LongType()),
    T.StructField("fork_events_cnt", T.LongType()),
])


def fact(spark, rows):
    from datetime import date

    return spark.createDataFrame(
        [(date.fromisoformat(d), i, n, w, f) for d, i, n, w, f in rows], FACT_SCHEMA
    )


def rows(df, *order):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))
