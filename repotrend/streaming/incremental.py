"""Incremental extraction of newly landed hour files.

A file-stream source over the landing root remembers, in its checkpoint, which
files it has seen.  Each micro-batch says which days have new files, and those
days are extracted again from all their landed hours, by the same call as a
batch run uses: so stream and batch write one table, and a repeated batch or a
re-landed hour replaces rows and never adds them twice.

The source's age limit is lifted, as an hour file may arrive long after newer
ones.  A file that was landed again under its old name is not new to the source;
at the end of a run the days of the window are therefore compared with the
ledger of extracted hours, and what differs is extracted as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from repotrend import schema as S
from repotrend.params import Window
from repotrend.plans.extraction import Extraction, extract_days
from repotrend.sources.raw import file_date

NO_AGE_LIMIT = "36500d"


def start_incremental_extract(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    reader = spark.readStream.schema(S.RAW_SCHEMA_WITH_PARTITIONS).option("maxFileAge", NO_AGE_LIMIT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    days = reader.json(raw_root).select(file_date().alias("file_date"))

    def extract(batch: DataFrame, _: int) -> None:
        found = [r.file_date for r in batch.distinct().collect()]  # days with new files
        extract_days(batch.sparkSession, raw_root, out_root, sorted(d for d in found if d), missing="keep")

    writer = days.writeStream.option("checkpointLocation", checkpoint).foreachBatch(extract)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_incremental_extract(spark: SparkSession, raw_root: str, out_root: str, checkpoint: str,
                            max_files_per_trigger: int | None = None, window: Window | None = None) -> Extraction | None:
    """Process every hour file landed since the last run, then what of the window's days differs from the ledger."""
    q = start_incremental_extract(spark, raw_root, out_root, checkpoint, max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return extract_days(spark, raw_root, out_root, window.dates(), missing="keep", only_pending=True) if window else None
