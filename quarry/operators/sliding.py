"""Counts per sliding event-time window; one function for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliding_counts(
    df: DataFrame,
    ts: str = "timestamp",
    size: str = "10 seconds",
    slide: str = "5 seconds",
    watermark: str | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Rows per ``[start, end)`` window of length ``size`` every ``slide``.

    Each row falls into size/slide windows (expanded, then partially
    aggregated before the shuffle). On a stream, ``watermark`` bounds the state
    and makes append mode emit each window once; without it state grows forever.
    """
    if watermark:
        df = df.withWatermark(ts, watermark)
    keys = [F.window(F.col(ts), size, slide).alias("w")] + [F.col(c) for c in (by or [])]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *(by or []), "count"
    )
