"""The gated end-to-end run for one anchor date.

extract raw -> curated  |  load sources  |  source checks  |  staging
|  staging checks  |  fact table  |  fact checks  |  mart tables  |  mart checks

Each layer is written, checked and then published: its tables are staged as version
folders, the checks and nothing else read those, and only if no error-severity check
fails do they become the tables.  A failure stops the run with the layer (and all
after it) as the last good run left it, by path and by name; warnings are reported.
Checks and later layers read Parquet, not the lineage back to the raw JSON.

With a database, tables are known by name there as well.  Staging is then a view: of
the source tables if its rows are read once, of rows stored once if they are read
more often, as they are by the checks and the fact of one run.  Source and stored
staging rows are in buckets by event id, so what groups or joins by it (distinct
rows, counts per id, unique checks) shuffles no events after the load.

``python -m repotrend.plans.run RAW OUT [--anchor D] ...`` is the form for
spark-submit.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from repotrend import schema as S
from repotrend.operators import marts
from repotrend.params import LAG_DAYS, RUN_DAYS, anchor_date, run_window
from repotrend.plans import pipeline, quality
from repotrend.plans.extraction import extract_days
from repotrend.session import configure, get_session, ship
from repotrend.sources import tables

LAYERS = ("extract", "source", "staging", "fact", "marts")


@dataclass
class RunResult:
    anchor: date
    paths: dict[str, str]
    checks: list[dict] = field(default_factory=list)
    extracted_dates: list[date] = field(default_factory=list)
    malformed_lines: int = 0
    database: str | None = None

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """A table or view of the run, by its name."""
        if name == "curated":
            return tables.read_curated(spark, self.paths[name])
        return spark.table(f"{self.database}.{name}") if self.database else tables.read_table(spark, self.paths[name])


def _staging_view(spark: SparkSession, database: str, kind: str) -> None:
    columns = ", ".join("to_date(event_ts) AS event_date" if c == "event_date" else c for c in S.STAGED_COLUMNS)
    spark.sql(
        f"CREATE OR REPLACE VIEW `{database}`.`{S.STAGED_TABLES[kind]}` AS SELECT DISTINCT {columns} "
        f"FROM `{database}`.`{S.KIND_TO_SOURCE_TABLE[kind]}` "
        "WHERE event_id IS NOT NULL AND repo_id IS NOT NULL AND event_ts IS NOT NULL")


def run(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    anchor: date | str | None = None,
    days: int = RUN_DAYS,
    lag_days: int = LAG_DAYS,
    enforce: bool = True,
    skip_extracted: bool = False,
    missing_raw: str = "raise",
    layers: Sequence[str] = LAYERS,
    database: str | None = None,
) -> RunResult:
    """Run the given layers for ``anchor`` (default: today, UTC).

    Loads the dates from ``days`` to ``lag_days`` before the anchor.  With
    ``skip_extracted`` only dates of which landed hours are not yet extracted are
    read again.  Dates without raw files stop the run before anything is written,
    or keep their curated rows with ``missing_raw="keep"``.  A layer that isn't
    named is taken as an earlier run left it in ``out_root``.  With ``enforce``
    off, failures are reported only.
    """
    configure(spark)
    if unknown := set(layers) - set(LAYERS):
        raise ValueError(f"no such layers: {sorted(unknown)}")
    a = anchor_date(anchor)
    window = run_window(a, days, lag_days)
    out = out_root.rstrip("/")
    names = [*S.KIND_TO_SOURCE_TABLE.values(), *S.STAGED_TABLES.values(), S.FACT_TABLE,
             S.TOP_WATCH_TABLE, S.TOP_FORK_TABLE, S.RISING_TABLE, S.INTENT_TABLE]
    result = RunResult(a, {n: f"{out}/{n}" for n in ["curated", *names]}, database=database)
    paths = result.paths

    places = dict(paths)  # where the rows are: those of a view in a folder of their own
    if database:
        places |= {n: f"{out}/_stored/{n}" for n in S.STAGED_TABLES.values()}

    def checked(layer: str, versions: dict[str, tables.Version]) -> None:
        """The checks of a layer over its staged versions; publishes them when none fails."""
        wanted = quality.layer_checks(layer, days, lag_days)
        frames = {n: tables.read_version(spark, places[n], v) for n, v in versions.items()}
        rep = quality.report({m: frames[m] for m in dict.fromkeys(c.model for c in wanted)}, wanted, a)
        result.checks += quality.gate(rep) if enforce else [r.asDict() for r in rep.collect()]
        for name, version in versions.items():
            tables.publish(spark, places[name], version)
            if database:
                tables.register(spark, database, name, places[name], version)
            tables.vacuum(spark, places[name])

    def staged(name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> tables.Version:
        return tables.Version((tables.stage(df, places[name], partition_by),))

    def staged_by_id(name: str, df: DataFrame) -> tables.Version:
        return tables.Version((tables.stage_bucketed(df, places[name], database, name, "event_id", dealt=True),))

    if "extract" in layers:
        done = extract_days(spark, raw_root, paths["curated"], window.dates(), missing_raw, only_pending=skip_extracted)
        result.extracted_dates, result.malformed_lines = done.dates, done.malformed

    if "source" in layers:
        checked("source", {
            name: tables.stage_source(spark, paths["curated"], kind, window.start, window.end, paths[name], tables.WRITE_TRUNCATE, database=database)
            for kind, name in S.KIND_TO_SOURCE_TABLE.items()})

    if "staging" in layers:
        src = [result.table(spark, n) for n in S.KIND_TO_SOURCE_TABLE.values()]
        frames = pipeline.staging_layer(*src)
        if database and staging_reads(layers) < 2:
            for kind in S.STAGED_TABLES:
                _staging_view(spark, database, kind)
        else:
            checked("staging", {name: staged_by_id(name, df) if database else staged(name, df) for name, df in frames.items()})

    if "fact" in layers:
        rows = [result.table(spark, n) for n in S.STAGED_TABLES.values()]
        fact = tables.clustered_fact(pipeline.fact_layer(*rows))
        checked("fact", {S.FACT_TABLE: staged(S.FACT_TABLE, fact, ("event_date",))})

    if "marts" in layers:
        weeks = f"{out}/_weeks"  # one pass over the fact for all four
        tables.write_table(marts.week_frame(result.table(spark, S.FACT_TABLE).select(*S.FACT_COLUMNS), a), weeks)
        made = marts.marts_of(tables.read_table(spark, weeks))
        checked("marts", {name: staged(name, df) for name, df in made.items()})
    return result


def staging_reads(layers: Sequence[str]) -> int:
    """How often a run of these layers reads the rows of a staged table: the plain checks, each unique check, the fact."""
    checks = quality.layer_checks("staging") if "staging" in layers else []
    model = [c for c in checks if c.model == S.STAGED_TABLES["watch"]]
    return (1 if model else 0) + sum(c.test == "unique" for c in model) + ("fact" in layers)


def main(argv: list[str] | None = None) -> RunResult:
    p = argparse.ArgumentParser(prog="repotrend.plans.run", description="One gated run.")
    p.add_argument("raw_root")
    p.add_argument("out_root")
    p.add_argument("--anchor")
    p.add_argument("--days", type=int, default=RUN_DAYS)
    p.add_argument("--lag-days", type=int, default=LAG_DAYS)
    p.add_argument("--layers", default=",".join(LAYERS))
    p.add_argument("--skip-extracted", action="store_true")
    p.add_argument("--missing-raw", choices=("raise", "keep"), default="raise")
    p.add_argument("--database")
    a = p.parse_args(argv)
    spark = get_session()
    ship(spark)
    return run(spark, a.raw_root, a.out_root, a.anchor, a.days, a.lag_days, skip_extracted=a.skip_extracted,
               missing_raw=a.missing_raw, layers=a.layers.split(","), database=a.database)


if __name__ == "__main__":
    main()
