"""Numeric column helpers used by the evaluation and recommendation jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squared_error(predicted: Column | str, actual: Column | str) -> Column:
    diff = _col(predicted) - _col(actual)
    return diff * diff


def similarity_bin(c: Column | str, n_thresholds: int = 100) -> Column:
    """``int(similarity * n)``: the bin of a similarity score (truncation)."""
    return (_col(c) * F.lit(n_thresholds)).cast("int")


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as a double, NULL when ``den`` is zero."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
