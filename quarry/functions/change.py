"""Relative change expressions with guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct_change(cur: Column, prev: Column) -> Column:
    """Signed percent change ``(cur - prev) / prev * 100``; null when prev is 0 or null."""
    return F.try_divide(cur - prev, prev) * F.lit(100.0)


def abs_pct_change(cur: Column, prev: Column) -> Column:
    """Absolute percent change, null when undefined."""
    return F.abs(pct_change(cur, prev))
