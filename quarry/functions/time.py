"""Time-of-day parsing and bucketing (replaces a row-at-a-time Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket bounds in hours and their labels, as the click job emits them.
DEFAULT_BOUNDS = (0, 6, 12, 18, 24)
DEFAULT_LABELS = ("0-6", "6-12", "12-18", "18-24")


def hour_of(time_col: Column | str) -> Column:
    """Integer hour before the first ``:`` of an ``H:mm[:ss]`` string.

    Null or unparsable text gives null instead of failing the task.
    """
    c = F.col(time_col) if isinstance(time_col, str) else time_col
    return F.split(c, ":", 2).getItem(0).try_cast("int")


def time_bucket(hour: Column, bounds=DEFAULT_BOUNDS, labels=DEFAULT_LABELS) -> Column:
    """Label of the half-open hour range ``[b_i, b_i+1)``.

    Any integer hour outside the earlier ranges (24 and above, or negative) falls
    into the last label, as in the original job; null stays null.
    """
    if len(labels) != len(bounds) - 1:
        raise ValueError("need one label per range")
    expr = None
    for lo, hi, lab in zip(bounds[:-2], bounds[1:-1], labels[:-1]):
        cond = (hour >= lo) & (hour < hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    last = F.lit(labels[-1])
    if expr is None:
        return F.when(hour.isNotNull(), last)
    return expr.when(hour.isNotNull(), last)


def time_string(ts: Column | str, fmt: str = "H:mm:ss") -> Column:
    """Render a timestamp as the clock-time text the click logs carry."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, fmt)
