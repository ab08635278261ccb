"""Extraction of days: landed raw hours to curated partitions, safely repeatable."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from repotrend.operators.extract import extract_events
from repotrend.sources import raw, tables


class RawMissing(FileNotFoundError):
    """Days were asked for that have no landed hour."""

    def __init__(self, days: list[date]):
        self.days = days
        super().__init__(f"{len(days)} day(s) have no landed raw hours, the first is {days[0]}")


@dataclass
class Extraction:
    dates: list[date] = field(default_factory=list)
    without_raw: list[date] = field(default_factory=list)
    written: set[tuple[str, date]] = field(default_factory=set)
    lines: int = 0
    malformed: int = 0


def extract_days(spark: SparkSession, raw_root: str, curated_root: str, days: list[date], missing: str = "raise", only_pending: bool = False) -> Extraction:
    """Replace the curated partitions of ``days`` by what their landed hours hold now.

    Days without any landed hour are never written: they raise
    :class:`RawMissing` before anything is, or are kept as they are and named in
    the result (``missing="keep"``).  With ``only_pending``, days that were
    extracted from just the hours now landed are skipped.  Lines that are no JSON
    objects are counted during the write.
    """
    if missing not in ("raise", "keep"):
        raise ValueError(f"missing is 'raise' or 'keep', not {missing!r}")
    found = raw.landed(spark, raw_root, days)
    landed = raw.signatures(found)
    wanted = tables.pending_dates(spark, curated_root, days, landed) if only_pending else list(days)
    out = Extraction(without_raw=[d for d in wanted if d not in landed])
    if out.without_raw and missing == "raise":
        raise RawMissing(out.without_raw)
    out.dates = [d for d in wanted if d in landed]
    if out.dates:
        seen = Observation("raw_lines")
        lines = raw.read_raw(spark, raw_root, dates=out.dates, with_corrupt=True, found=found).observe(
            seen, F.count(F.lit(1)).alias("lines"), F.count_if(raw.no_json()).alias("malformed"))
        out.written = tables.write_curated(extract_events(lines), curated_root, {d: landed[d] for d in out.dates})
        out.lines, out.malformed = int(seen.get["lines"]), int(seen.get["malformed"])
    return out
