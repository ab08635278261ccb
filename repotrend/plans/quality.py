"""Data-quality checks and layer gates.

Each check has a *failing-rows* form (zero rows = pass), like a warehouse
data test:

* ``not_null``         rows where the column is NULL
* ``unique``           (unique_field, n_records) for non-NULL values seen twice+
* ``accepted_values``  (value_field, n_records) for values outside the list;
                       NULL passes
* ``date_coverage``    (distinct_date_count) when a date is missing among those
                       from ``days`` to ``lag`` before the anchor

and a *count* form used by the report: the number of failing rows.  The
report computes all not_null / accepted_values / coverage counts of a model
in one aggregate pass, and each ``unique`` with one partial aggregate, then
unions them into ``(layer, model, test, column_name, severity, failures,
status)``.  Only that small table (one row per check) reaches the driver,
when a gate decides whether the next layer may run.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repotrend.functions import in_trailing_window
from repotrend.params import LAG_DAYS, RUN_DAYS

ERROR = "error"
WARN = "warn"


class DataQualityError(RuntimeError):
    """An error-severity check failed; later layers must not run."""

    def __init__(self, failed: list[dict]):
        self.failed = failed
        names = ", ".join(f"{r['model']}.{r['test']}({r['column_name']})" for r in failed)
        super().__init__(f"{len(failed)} data-quality check(s) failed: {names}")


@dataclass(frozen=True)
class Check:
    layer: str
    model: str
    test: str  # not_null | unique | accepted_values | date_coverage
    column: str
    severity: str = ERROR
    values: tuple[str, ...] = field(default_factory=tuple)
    days: int = RUN_DAYS
    lag: int = LAG_DAYS


# --------------------------------------------------------- failing rows

def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def accepted_values_failures(df: DataFrame, column: str, values) -> DataFrame:
    return (
        df.groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(~F.col("value_field").isin(*values))
    )


def _covered_date(ts_column: str, anchor: date | str, days: int, lag: int) -> Column:
    d = F.to_date(F.col(ts_column))
    return F.when(in_trailing_window(d, anchor, days, lag - 1), d)


def date_coverage_failures(
    df: DataFrame, ts_column: str, anchor: date | str, days: int = RUN_DAYS, lag: int = LAG_DAYS
) -> DataFrame:
    found = df.agg(F.count_distinct(_covered_date(ts_column, anchor, days, lag)).alias("distinct_date_count"))
    return found.where(F.col("distinct_date_count") < days - lag + 1)


# ---------------------------------------------------------------- report

def _sql_str(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _row_sql(check: Check, failures: str) -> str:
    """One report row as a SQL struct over a failure-count expression.

    The report is built from SQL text (a handful of calls per model) rather
    than thousands of small Column objects: its cost is then one analysis,
    not a driver round trip per literal.
    """
    n = f"cast({failures} as bigint)"
    status = (
        f"case when {n} = 0 then 'pass' "
        + ("else 'warn' end" if check.severity == WARN else "else 'fail' end")
    )
    return (
        f"named_struct('layer', {_sql_str(check.layer)}, 'model', {_sql_str(check.model)}, "
        f"'test', {_sql_str(check.test)}, 'column_name', {_sql_str(check.column)}, "
        f"'severity', {_sql_str(check.severity)}, 'failures', {n}, 'status', {status})"
    )


def _date_window_sql(ts_col: str, anchor, check: Check) -> str:
    d = f"to_date({ts_col})"
    a = f"date {_sql_str(str(anchor))}"
    return f"case when {d} between date_sub({a}, {check.days}) and date_sub({a}, {check.lag}) then {d} end"


def model_report(df: DataFrame, checks: list[Check], anchor: date | str) -> DataFrame:
    """Report rows for the checks of one model.

    not_null / accepted_values / date_coverage: one global aggregate over
    the model.  unique: one partial aggregate per column.  NULL values pass
    accepted_values (``NULL NOT IN (...)`` is not true).
    """
    parts: list[DataFrame] = []
    single_pass = [c for c in checks if c.test != "unique"]
    if single_pass:
        aggs, rows = [], []
        for i, c in enumerate(single_pass):
            col = f"`{c.column}`"
            if c.test == "not_null":
                aggs.append(f"count_if({col} is null) as _c{i}")
                n = f"_c{i}"
            elif c.test == "accepted_values":
                vals = ", ".join(_sql_str(v) for v in c.values)
                aggs.append(f"count(distinct case when not ({col} in ({vals})) then {col} end) as _c{i}")
                n = f"_c{i}"
            elif c.test == "date_coverage":
                aggs.append(f"count(distinct {_date_window_sql(col, anchor, c)}) as _c{i}")
                n = f"case when _c{i} < {c.days - c.lag + 1} then 1 else 0 end"
            else:
                raise ValueError(f"unknown test {c.test}")
            rows.append(_row_sql(c, n))
        parts.append(df.selectExpr(*aggs).selectExpr(f"inline(array({', '.join(rows)}))"))
    for c in checks:
        if c.test == "unique":
            col = f"`{c.column}`"
            dup = df.where(f"{col} is not null").groupBy(c.column).count().where("count > 1")
            parts.append(
                dup.selectExpr("count(1) as _n").selectExpr(f"inline(array({_row_sql(c, '_n')}))")
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report(tables: dict[str, DataFrame], checks: list[Check], anchor: date | str) -> DataFrame:
    """Report over several models; ``tables`` maps model name -> DataFrame."""
    out = None
    for model in dict.fromkeys(c.model for c in checks):
        part = model_report(tables[model], [c for c in checks if c.model == model], anchor)
        out = part if out is None else out.unionByName(part)
    return out


def gate(report_df: DataFrame) -> list[dict]:
    """Collect a layer's report (one row per check) and stop on an error.

    Warnings are returned, not raised.
    """
    rows = [r.asDict() for r in report_df.collect()]
    failed = [r for r in rows if r["status"] == "fail"]
    if failed:
        raise DataQualityError(failed)
    return rows


# ------------------------------------------------- the pipeline's checks

def _nn(layer, model, *cols):
    return [Check(layer, model, "not_null", c) for c in cols]


def pipeline_checks(days: int = RUN_DAYS, lag: int = LAG_DAYS) -> list[Check]:
    """The checks gating each layer (fixed list: 27 not_null, 4 unique,
    3 accepted_values, 2 date coverage) of a run that loads the dates from
    ``days`` to ``lag`` before its anchor."""
    checks: list[Check] = []
    for model in ("source_watch_events", "source_fork_events"):
        checks += [
            Check("source", model, "date_coverage", "event_ts", days=days, lag=lag),
            Check("source", model, "not_null", "event_id"),
            Check("source", model, "unique", "event_id", severity=WARN),
            Check("source", model, "not_null", "event_ts"),
        ]
    for model, etype, sev in (
        ("stg_watch_events", "WatchEvent", WARN),
        ("stg_fork_events", "ForkEvent", ERROR),
    ):
        checks += [
            Check("staging", model, "not_null", "event_id"),
            Check("staging", model, "unique", "event_id", severity=sev),
            Check("staging", model, "not_null", "event_type"),
            Check("staging", model, "accepted_values", "event_type", values=(etype,)),
            Check("staging", model, "not_null", "event_date"),
            Check("staging", model, "not_null", "repo_id"),
        ]
    checks += _nn("fact", "fct_repo_daily_watch_fork_metrics", "event_date", "repo_id", "repo_name")
    checks += _nn("marts", "marts_watch_top_repos_7d", "repo_id", "repo_name", "weekly_watch_count")
    checks += _nn("marts", "marts_fork_top_repos_7d", "repo_id", "repo_name", "weekly_fork_count")
    checks += _nn(
        "marts",
        "marts_watch_rasing_repos_7d",
        "repo_id",
        "repo_name",
        "current_week_watch_count",
        "prev_week_watch_count",
        "watch_count_delta",
    )
    checks += [
        Check("marts", "marts_repo_intent_classification", "not_null", "intent_type"),
        Check(
            "marts",
            "marts_repo_intent_classification",
            "accepted_values",
            "intent_type",
            values=("usage_driven", "interest_driven", "balanced"),
        ),
    ]
    return checks


def layer_checks(layer: str, days: int = RUN_DAYS, lag: int = LAG_DAYS) -> list[Check]:
    return [c for c in pipeline_checks(days, lag) if c.layer == layer]
