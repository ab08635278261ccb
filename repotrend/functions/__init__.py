"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from repotrend.functions.expressions import (
    countif,
    days_before,
    in_trailing_window,
    null_if_zero,
    safe_divide,
    smoothed_ratio,
)

__all__ = [
    "countif",
    "days_before",
    "in_trailing_window",
    "null_if_zero",
    "safe_divide",
    "smoothed_ratio",
]
