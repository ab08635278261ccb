"""Warehouse-dialect scalar and aggregate helpers as Spark built-ins.

Each returns a ``Column`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    """Double quotient, NULL when the denominator is zero or NULL."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def null_if_zero(c: str | Column) -> Column:
    return F.nullif(_col(c), F.lit(0))


def countif(condition: Column) -> Column:
    """Rows where ``condition`` is true (NULL counts as false)."""
    return F.count_if(condition)


def days_before(anchor: date | str | Column, days: int) -> Column:
    anchor_col = anchor if isinstance(anchor, Column) else F.lit(anchor).cast("date")
    return F.date_sub(anchor_col, days) if days else anchor_col


def in_trailing_window(
    date_col: str | Column, anchor: date | str | Column, start_days: int, end_days: int = 0
) -> Column:
    """Half-open ``[anchor - start_days, anchor - end_days)``.

    On a partition column this becomes a partition filter; on a Parquet
    column it is pushed to the scan.
    """
    c = _col(date_col)
    return (c >= days_before(anchor, start_days)) & (c < days_before(anchor, end_days))


def smoothed_ratio(current: str | Column, previous: str | Column) -> Column:
    """``(cur + 1.0) / (prev + 1.0)`` in double precision."""
    one = F.lit(1.0)
    return (_col(current).cast("double") + one) / (_col(previous).cast("double") + one)
