"""DuckDB SQL equal to each registered query (the correctness oracle).

Written from what each layer means, not from how the Spark code gets there:
staged events are the distinct rows; an event id's number of rows is a window
count; a day of the fact is one grouping of both kinds, in which rows without a
name are kept apart by kind (as equality on names would); the weeks are filtered
sums of one grouping.  Sums are cast to BIGINT (DuckDB's sum of BIGINT is
HUGEINT); ratios are DOUBLE; top-k ties break on repo_id, then repo_name with
NULL first.  The 36 checks of the report are listed here on their own.
"""

from __future__ import annotations

from repotrend.sources.feed import CLEAN_FILTER_SQL, FEED_SQL, FIXTURE_ANCHOR, SKEWED_FEED_SQL

A = f"date '{FIXTURE_ANCHOR}'"
W0, W1 = f"{A} - interval 14 day", f"{A} - interval 1 day"

# Fixed values, as in the pipeline: volume floor, ratio bounds, list length.
FLOOR, HIGH, LOW, TOP = 20, "1.2::double", "0.5::double", 10

_WATCH = (
    "event_id, event_type, event_ts, event_hour, repo_id, repo_name, actor_id, actor_login, "
    "org_id, org_login, action, is_public"
)
_FORK = _WATCH.replace("is_public", "forkee_repo_id, forkee_repo_name, is_public")
_STAGED = _WATCH.replace("event_hour", "event_date, event_hour")
_EXTRACTED = _FORK.replace("event_hour", "event_date, event_hour")


def _layers(clean: bool = False, landed: bool = False, text: str = FEED_SQL) -> str:
    """All layers as CTEs; ``landed``: of a run, so of its window's dates and in whole seconds."""
    kept = CLEAN_FILTER_SQL if clean else "true"
    rows = f"file_date between {W0} and {W1}" if landed else "true"
    ts = "date_trunc('second', event_ts)" if landed else "event_ts"
    return f"""with feed as (select * from ({text}) where {kept}),
ev as (
  select *, cast(event_ts as date) as event_date, cast(event_ts as date) as file_date,
    case event_type when 'ForkEvent' then 'fork' else 'watch' end as kind,
    case event_type when 'ForkEvent' then 1000000 + repo_id end as forkee_repo_id,
    case event_type when 'ForkEvent' then concat(actor_login, '/fork') end as forkee_repo_name
  from feed where event_type in ('WatchEvent', 'ForkEvent')),
src as (select * replace ({ts} as event_ts) from ev where {rows}),
ext as (select * replace (date_trunc('second', event_ts) as event_ts) from ev),
keyed as (
  select kind, {_STAGED}, count(*) over (partition by kind, event_id) as copies
  from src where event_id is not null and repo_id is not null and event_ts is not null),
stg as (select distinct kind, {_STAGED} from keyed),
fct as (
  select event_date, repo_id, repo_name, count(*) filter (where kind = 'watch') as watch_events_cnt,
    count(*) filter (where kind = 'fork') as fork_events_cnt
  from stg group by event_date, repo_id, repo_name, case when repo_name is null then kind end),
weeks as (
  select repo_id, repo_name, bool_or(event_date >= {A} - interval 7 day) as now, bool_or(event_date < {A} - interval 7 day) as past,
    cast(sum(watch_events_cnt) filter (where event_date >= {A} - interval 7 day) as bigint) as weekly_watch_count,
    cast(sum(fork_events_cnt) filter (where event_date >= {A} - interval 7 day) as bigint) as weekly_fork_count,
    cast(sum(watch_events_cnt) filter (where event_date < {A} - interval 7 day) as bigint) as prev_week_watch_count
  from fct where event_date >= {A} - interval 14 day and event_date < {A} group by repo_id, repo_name),
growth as (
  select repo_id, repo_name, weekly_watch_count as cur, case when repo_name is null then 0 else coalesce(prev_week_watch_count, 0) end as prev
  from weeks where now),
rising as (
  select repo_id, repo_name, cur as current_week_watch_count, prev as prev_week_watch_count, cur - prev as watch_count_delta,
    (cur + 1.0::double) / (prev + 1.0::double) as watch_growth_ratio
  from growth),
activity as (
  select repo_id, repo_name, weekly_watch_count, weekly_fork_count,
    if(greatest(weekly_watch_count, weekly_fork_count) < {FLOOR}, 'low_signal', 'active') as activity_label
  from weeks where now),
intent as (
  select repo_id, repo_name, weekly_watch_count, weekly_fork_count,
    case when weekly_watch_count > 0 and weekly_fork_count::double / weekly_watch_count >= {HIGH} then 'usage_driven'
         when weekly_watch_count > 0 and weekly_fork_count::double / weekly_watch_count <= {LOW} then 'interest_driven'
         else 'balanced' end as repo_intent_type
  from activity where activity_label = 'active'),
rates as (
  select t.intent_type, avg(case when i.repo_intent_type = t.intent_type then 1.0::double when i.repo_intent_type is not null then 0 end) as rate
  from (values ('usage_driven'), ('interest_driven'), ('balanced')) t(intent_type) left join intent i on true
  group by t.intent_type),
top_watch as (select repo_id, repo_name, weekly_watch_count from weeks where now
  order by weekly_watch_count desc, repo_id nulls first, repo_name nulls first limit {TOP}),
top_fork as (select repo_id, repo_name, weekly_fork_count from weeks where now
  order by weekly_fork_count desc, repo_id nulls first, repo_name nulls first limit {TOP}),
rise as (select * from rising where current_week_watch_count >= {FLOOR})
"""


def _q(body: str, clean: bool = False, landed: bool = False, text: str = FEED_SQL) -> str:
    return _layers(clean, landed, text) + body


ORACLE: dict[str, str] = {}
for _kind, _columns in (("watch", _WATCH), ("fork", _FORK)):
    _of = f"where kind = '{_kind}'"
    ORACLE |= {
        f"stg_required_keys_{_kind}": _q(f"select {_STAGED} from keyed {_of}"),
        f"event_id_counts_{_kind}": _q(f"select distinct event_id, copies as row_count from keyed {_of}"),
        f"unique_event_ids_{_kind}": _q(f"select event_id from keyed {_of} and copies = 1"),
        f"duplicate_event_ids_{_kind}": _q(f"select distinct event_id from keyed {_of} and copies > 1"),
        f"non_duplicate_events_{_kind}": _q(f"select {_STAGED} from keyed {_of} and copies = 1"),
        f"duplicate_events_{_kind}": _q(f"select {_STAGED} from keyed {_of} and copies > 1"),
        f"dedup_duplicates_{_kind}": _q(f"select distinct {_STAGED} from keyed {_of} and copies > 1"),
        f"stg_{_kind}_events": _q(f"select {_STAGED} from stg {_of}"),
        f"stg_{_kind}_events_stepwise": _q(f"select {_STAGED} from stg {_of}"),
        f"daily_{_kind}_counts": _q(
            f"select event_date, repo_id, repo_name, count(*) as {_kind}_events_cnt from stg {_of} group by all"),
        f"weekly_{_kind}": _q(f"select repo_id, repo_name, weekly_{_kind}_count from weeks where now"),
        f"mart_top_{_kind}": _q(f"select * from top_{_kind}"),
        f"dq_unique_{_kind}": _q(
            f"select event_id as unique_field, count(*) as n_records from stg {_of} group by event_id having count(*) > 1"),
        f"extract_{_kind}": _q(f"select {_columns.replace('event_hour', 'event_date, event_hour')} from ext {_of}"),
    }

for _kind in ("watch", "fork"):
    ORACLE |= {f"{name}_bucketed_{_kind}": ORACLE[f"{like}_{_kind}{end}"] for name, like, end in (
        ("stg_events", "stg", "_events"), ("duplicate_events", "duplicate_events", ""), ("dq_unique", "dq_unique", ""))}

ORACLE |= {
    "fct_skewed": _q("select * from fct", text=SKEWED_FEED_SQL),
    "weekly_watch_skewed": _q("select repo_id, repo_name, weekly_watch_count from weeks where now", text=SKEWED_FEED_SQL),
    "duplicate_events_skewed": _q(f"select {_STAGED} from keyed where kind = 'watch' and copies > 1", text=SKEWED_FEED_SQL),
}

# The step queries first registered for one kind.
ORACLE |= {
    name: ORACLE[f"{name}_{kind}"]
    for kind, names in {
        "watch": ("stg_required_keys", "event_id_counts", "non_duplicate_events"),
        "fork": ("unique_event_ids", "duplicate_event_ids", "duplicate_events", "dedup_duplicates", "dq_unique"),
    }.items() for name in names
}

ORACLE |= {
    "relevant_events": _q(f"select {_WATCH} from ev"),
    "fct_repo_daily": _q("select * from fct"),
    "fct_repo_daily_join": _q("select * from fct"),
    "fct_pruned_read": _q(f"select * from fct where event_date between {A} - interval 7 day and {W1}"),
    "fct_one_repo": _q("select * from fct where repo_id = 11"),
    "prev_week_watch": _q("select repo_id, repo_name, prev_week_watch_count from weeks where past"),
    "weekly_watch_fork": _q("select repo_id, repo_name, weekly_watch_count, weekly_fork_count from weeks where now"),
    "mart_rising": _q("select * from rise"),
    "mart_rising_join": _q("select * from rise"),
    "mart_rising_all": _q("select * from rising"),
    "repo_activity": _q("select * from activity"),
    "repo_intent": _q("select * from intent"),
    "mart_intent_rates": _q("select * from rates"),
    "dq_not_null": _q("select * from fct where repo_name is null"),
    "dq_accepted_values": _q(
        "select event_type as value_field, count(*) as n_records from feed "
        "where event_type not in ('WatchEvent', 'ForkEvent') group by event_type"),
    "dq_date_coverage": _q(
        "select * from (select count(distinct event_date) as distinct_date_count from src where kind = 'watch' "
        f"and event_date between {W0} and {W1}) where distinct_date_count < 14"),
    "dq_date_coverage_month": _q(
        "select * from (select count(distinct event_date) as distinct_date_count from src where kind = 'fork' "
        f"and event_date between {A} - interval 30 day and {W1}) where distinct_date_count < 30"),
}

# Hours, dates and landed files.
_NAME = "strftime(hour_ts, '%Y-%m-%d-') || hour(hour_ts) || '.json.gz'"
_MANIFEST = (
    f"select hour_ts, {_NAME} as file_name, 'https://archive.example.org/' || {_NAME} as url, "
    f"strftime(hour_ts, 'raw/year=%Y/month=%m/day=%d/hour=%H/') || {_NAME} as object_path from "
)
_HOURS = ("(select unnest(generate_series(date_trunc('hour', min(event_ts)), date_trunc('hour', max(event_ts)), "
          "interval 1 hour)) as hour_ts from feed)")
_SPINE = ("(select cast(unnest(generate_series(cast(min(event_ts) as date), cast(max(event_ts) as date), interval 1 day)) "
          "as date) as file_date from feed)")
_RAW_ROW = (
    "select event_id as id, event_type as type, strftime(event_ts, '%Y-%m-%dT%H:%M:%SZ') as created_at, is_public as public, "
    "actor_id, actor_login, repo_id, repo_name, org_id, org_login, action, "
    "if(event_type = 'ForkEvent', 1000000 + repo_id, null) as forkee_id, "
    "if(event_type = 'ForkEvent', concat(actor_login, '/fork'), null) as forkee_full_name, "
    "cast(year(event_ts) as integer) as year, cast(month(event_ts) as integer) as month, "
    "cast(day(event_ts) as integer) as day, cast(hour(event_ts) as integer) as hour from feed "
)
_BROKEN = "count(*) filter (where cast(event_id as bigint) % 211 = 0)"
_ALL_EXTRACTED = f"select kind, file_date, {_EXTRACTED} from ext"
_IN_WINDOW = f"file_date between {W0} and {W1}"

ORACLE |= {
    "hour_manifest": _q(_MANIFEST + _HOURS),
    "missing_hours_first_run": _q(_MANIFEST + _HOURS),
    "missing_hours": _q(
        _MANIFEST + "(select unnest(generate_series(timestamp '2024-01-18 00:00:00', timestamp '2024-02-01 00:00:00', "
        "interval 1 hour)) as hour_ts) h where hour_ts not in (select date_trunc('hour', event_ts) from feed)"),
    "date_spine": _q(f"select file_date from {_SPINE}"),
    "transform_dates": _q(
        "select cast(unnest(generate_series(cast(last - interval 13 day as date), last, interval 1 day)) as date) as file_date "
        "from (select cast(max(event_ts) - interval 3 hour as date) as last from feed)"),
    "partition_date_counts": _q(f"select event_type, count(*) as n from feed where cast(event_ts as date) = {W1} group by event_type"),
    "pending_dates": _q(
        f"select file_date from {_SPINE} where file_date not in "
        f"(select cast(event_ts as date) from feed where cast(event_ts as date) between {W0} and {W1})"),
    "pending_after_late_hour": _q("select distinct file_date from (select cast(event_ts as date) as file_date from feed) where file_date = date '2024-01-20'"),
    "raw_scan_pruned": _q(_RAW_ROW + "where cast(event_ts as date) = date '2024-01-15'"),
    "raw_corrupt_counts": _q(
        f"select cast(event_ts as date) as file_date, count(*) + {_BROKEN} as n_lines, {_BROKEN} as n_malformed from feed group by 1"),
    "raw_roundtrip": _q(_ALL_EXTRACTED),
    "land_skip_existing": _q(_ALL_EXTRACTED),
    "stream_extract": _q(_ALL_EXTRACTED),
    "extract_range": _q(f"{_ALL_EXTRACTED} where {_IN_WINDOW}"),
    "extract_missing_raw": _q(f"{_ALL_EXTRACTED} where {_IN_WINDOW}"),
    "curated_range_scan": _q(f"select {_FORK} from ext where kind = 'fork' and file_date between {A} - interval 7 day and {W1}"),
    "load_truncate": _q(f"select {_WATCH} from ext where kind = 'watch' and {_IN_WINDOW}"),
    "load_append": _q(f"select {_WATCH} from ext where kind = 'watch' and {_IN_WINDOW}"),
    "load_append_retried": _q(f"select {_WATCH} from ext where kind = 'watch' and {_IN_WINDOW}"),
    "load_empty": _q(f"select {_FORK} from ext where kind = 'fork' and {_IN_WINDOW}"),
    "loaded_rows": _q(f"select kind, 'source_' || kind || '_events' as table_name, count(*) as n from ext where {_IN_WINDOW} group by kind"),
    "run_pipeline": _q("select * from top_watch", landed=True),
    "run_pipeline_rising": _q("select * from rise", landed=True),
    "run_gated": _q("select * from top_watch", clean=True, landed=True),
    "gate_keeps_fact": _q("select * from fct", clean=True, landed=True),
    "run_tables_sql": _q("select repo_id, repo_name, weekly_watch_count, weekly_fork_count from top_watch join top_fork using (repo_id, repo_name)", landed=True),
}

# The checks: layer | model | rows it is on | severity | test and column.
CHECKS = """
source | source_watch_events | src where kind = 'watch' | error | coverage event_ts
source | source_watch_events | src where kind = 'watch' | error | not_null event_id
source | source_watch_events | src where kind = 'watch' | warn | unique event_id
source | source_watch_events | src where kind = 'watch' | error | not_null event_ts
source | source_fork_events | src where kind = 'fork' | error | coverage event_ts
source | source_fork_events | src where kind = 'fork' | error | not_null event_id
source | source_fork_events | src where kind = 'fork' | warn | unique event_id
source | source_fork_events | src where kind = 'fork' | error | not_null event_ts
staging | stg_watch_events | stg where kind = 'watch' | error | not_null event_id
staging | stg_watch_events | stg where kind = 'watch' | warn | unique event_id
staging | stg_watch_events | stg where kind = 'watch' | error | not_null event_type
staging | stg_watch_events | stg where kind = 'watch' | error | accepted event_type WatchEvent
staging | stg_watch_events | stg where kind = 'watch' | error | not_null event_date
staging | stg_watch_events | stg where kind = 'watch' | error | not_null repo_id
staging | stg_fork_events | stg where kind = 'fork' | error | not_null event_id
staging | stg_fork_events | stg where kind = 'fork' | error | unique event_id
staging | stg_fork_events | stg where kind = 'fork' | error | not_null event_type
staging | stg_fork_events | stg where kind = 'fork' | error | accepted event_type ForkEvent
staging | stg_fork_events | stg where kind = 'fork' | error | not_null event_date
staging | stg_fork_events | stg where kind = 'fork' | error | not_null repo_id
fact | fct_repo_daily_watch_fork_metrics | fct where true | error | not_null event_date
fact | fct_repo_daily_watch_fork_metrics | fct where true | error | not_null repo_id
fact | fct_repo_daily_watch_fork_metrics | fct where true | error | not_null repo_name
marts | marts_watch_top_repos_7d | top_watch where true | error | not_null repo_id
marts | marts_watch_top_repos_7d | top_watch where true | error | not_null repo_name
marts | marts_watch_top_repos_7d | top_watch where true | error | not_null weekly_watch_count
marts | marts_fork_top_repos_7d | top_fork where true | error | not_null repo_id
marts | marts_fork_top_repos_7d | top_fork where true | error | not_null repo_name
marts | marts_fork_top_repos_7d | top_fork where true | error | not_null weekly_fork_count
marts | marts_watch_rasing_repos_7d | rise where true | error | not_null repo_id
marts | marts_watch_rasing_repos_7d | rise where true | error | not_null repo_name
marts | marts_watch_rasing_repos_7d | rise where true | error | not_null current_week_watch_count
marts | marts_watch_rasing_repos_7d | rise where true | error | not_null prev_week_watch_count
marts | marts_watch_rasing_repos_7d | rise where true | error | not_null watch_count_delta
marts | marts_repo_intent_classification | rates where true | error | not_null intent_type
marts | marts_repo_intent_classification | rates where true | error | accepted intent_type usage_driven interest_driven balanced
"""


def _report() -> str:
    rows = []
    for line in CHECKS.strip().splitlines():
        layer, model, on, severity, test = (x.strip() for x in line.split(" | "))
        kind, column, *values = test.split()
        if kind == "not_null":
            name, n = kind, f"select count(*) from {on} and {column} is null"
        elif kind == "unique":
            name, n = kind, f"select count(*) from (select {column} from {on} and {column} is not null group by {column} having count(*) > 1)"
        elif kind == "accepted":
            name, n = "accepted_values", f"select count(distinct {column}) from {on} and {column} not in ({', '.join(repr(v) for v in values)})"
        else:
            d = f"cast({column} as date)"
            name, n = "date_coverage", f"select if(count(distinct {d}) < 14, 1, 0) from {on} and {d} between {W0} and {W1}"
        rows.append(f"select '{layer}' as layer, '{model}' as model, '{name}' as test, '{column}' as column_name, "
                    f"'{severity}' as severity, cast(({n}) as bigint) as failures")
    body = "\nunion all ".join(rows)
    return f"select *, case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status from ({body})"


_ORDER = "list_position(['source', 'staging', 'fact', 'marts'], layer)"
ORACLE |= {
    "dq_report": _q(_report()),
    "run_plain_report": _q(_report(), landed=True),
    "gate_stop": _q(
        f"select model, test, column_name, failures from (select *, min({_ORDER}) over () as first from ({_report()}) where status = 'fail') "
        f"where {_ORDER} = first", landed=True),
}
