"""End-to-end plans.

* :func:`layers` composes every layer lazily from two source DataFrames.
* :func:`in_memory_layers` does so over the feed binding (no writes).
* :func:`quality_report` gives the report of all 36 checks over such layers.
* :func:`run` (in :mod:`repotrend.plans.run`) materialises each layer as a
  table and gates it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from repotrend import schema as S
from repotrend.operators import facts, marts, staging
from repotrend.plans import quality
from repotrend.session import configure, work_dir
from repotrend.sources import feed as feeds


def staging_layer(src_watch: DataFrame, src_fork: DataFrame) -> dict[str, DataFrame]:
    return {
        S.STAGED_TABLES["watch"]: staging.stage_events(src_watch),
        S.STAGED_TABLES["fork"]: staging.stage_events(src_fork),
    }


def fact_layer(stg_watch: DataFrame, stg_fork: DataFrame) -> DataFrame:
    return facts.repo_daily_fact(stg_watch, stg_fork)


def mart_layer(fact: DataFrame, anchor: date | str) -> dict[str, DataFrame]:
    return {
        S.TOP_WATCH_TABLE: marts.top_watched(fact, anchor),
        S.TOP_FORK_TABLE: marts.top_forked(fact, anchor),
        S.RISING_TABLE: marts.rising_repos(fact, anchor),
        S.INTENT_TABLE: marts.intent_rates_for(fact, anchor),
    }


def layers(src_watch: DataFrame, src_fork: DataFrame, anchor: date | str) -> dict[str, DataFrame]:
    out = {
        S.KIND_TO_SOURCE_TABLE["watch"]: src_watch,
        S.KIND_TO_SOURCE_TABLE["fork"]: src_fork,
    }
    out.update(staging_layer(src_watch, src_fork))
    out[S.FACT_TABLE] = fact_layer(out[S.STAGED_TABLES["watch"]], out[S.STAGED_TABLES["fork"]])
    out.update(mart_layer(out[S.FACT_TABLE], anchor))
    return out


def layers_written(src_watch: DataFrame, src_fork: DataFrame, anchor: date | str, root: str) -> dict[str, DataFrame]:
    """Like :func:`layers`, but the source, staged and fact layers are written as
    Parquet tables below ``root`` before the next reads them, so each consumer
    (the branches of a quality report, say) scans the columns it needs of a
    written layer.  Marts are small aggregates of the written fact."""

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")

    sources = zip(S.KIND_TO_SOURCE_TABLE.values(), (src_watch, src_fork), strict=True)
    out = {name: written(df, name) for name, df in sources}
    out.update({k: written(v, k) for k, v in staging_layer(*out.values()).items()})
    out[S.FACT_TABLE] = written(fact_layer(out[S.STAGED_TABLES["watch"]], out[S.STAGED_TABLES["fork"]]), S.FACT_TABLE)
    out.update(mart_layer(out[S.FACT_TABLE], anchor))
    return out


def in_memory_layers(
    spark: SparkSession,
    sf_dir: str,
    clean: bool = False,
    anchor: date | str = feeds.FIXTURE_ANCHOR,
    written: bool = False,
) -> dict[str, DataFrame]:
    configure(spark)
    src = feeds.sources(spark, sf_dir, clean=clean)
    if written:
        out = layers_written(src["watch"], src["fork"], anchor, work_dir(spark))
    else:
        out = layers(src["watch"], src["fork"], anchor)
    out["fct_repo_daily"] = out[S.FACT_TABLE]
    return out


def quality_report(tables: dict[str, DataFrame], anchor: date | str) -> DataFrame:
    return quality.report(tables, quality.pipeline_checks(), anchor)
