"""Parquet table access for the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load_table(
    spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None
) -> DataFrame:
    """Read one driver table; ``columns`` prunes the scan (ReadSchema)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def to_event_time(df: DataFrame, *cols: str) -> DataFrame:
    """Cast TIMESTAMP_NTZ columns to TIMESTAMP (needed by ``withWatermark``).

    The session time zone decides the instant; sessions built by
    ``quarry.session.get_spark`` use UTC.
    """
    names = cols or tuple(
        f.name for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)
    )
    return df.withColumns({c: F.col(c).cast("timestamp") for c in names})
