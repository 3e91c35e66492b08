"""Click counts per time-of-day range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.time import DEFAULT_BOUNDS, DEFAULT_LABELS, hour_of, time_bucket


def with_time_bucket(
    df: DataFrame, time_col: str = "Time", out: str = "time_range",
    bounds=DEFAULT_BOUNDS, labels=DEFAULT_LABELS,
) -> DataFrame:
    return df.withColumn(out, time_bucket(hour_of(F.col(time_col)), bounds, labels))


def time_bucket_counts(
    df: DataFrame, time_col: str = "Time", out: str = "time_range",
    bounds=DEFAULT_BOUNDS, labels=DEFAULT_LABELS,
) -> DataFrame:
    """Rows per time-of-day range (partial + final hash aggregate, no Python).

    Rows whose time is null or unparsable land in a null range.
    """
    return (
        with_time_bucket(df.select(time_col), time_col, out, bounds, labels)
        .groupBy(out)
        .agg(F.count(F.lit(1)).alias("count"))
    )
