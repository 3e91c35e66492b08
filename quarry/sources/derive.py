"""Shapes the jobs expect, derived by Spark from the driver tables.

Each derivation is a projection of a whole table, so the work grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.json import to_json_value
from quarry.functions.time import time_string

# Fixed values of the SCD fixture (see FIXTURES.md): validity dates and as-of.
OPEN_START = "2020-01-01 00:00:00"
EXPIRED_START = "2019-01-01 00:00:00"
SENTINEL = "9999-12-31 00:00:00"
SCD_AS_OF = "2024-01-01 00:00:00"


def ntz(text: str):
    return F.to_timestamp_ntz(F.lit(text))


def ticks_from_events(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """OHLCV bars: ticker = user, close = value, volume = value in cents."""
    v = F.col("value")
    return events.select(
        *(keep or []),
        F.col("user_id").alias("stock_ticker"),
        F.col("ts").alias("timestamp"),
        v.alias("open"),
        v.alias("high"),
        v.alias("low"),
        v.alias("close"),
        F.round(v * 100).cast("bigint").alias("volume"),
        F.col("event_id"),
    )


def clicks_from_events(events: DataFrame) -> DataFrame:
    """Click log rows as text: Date, Time (H:mm:ss), UserID."""
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("Date"),
        time_string("ts").alias("Time"),
        F.col("user_id").cast("string").alias("UserID"),
    )


def bar_text_from_events(events: DataFrame) -> DataFrame:
    """Untyped CSV-like bars; error events carry a non-numeric close."""
    v = F.col("value").cast("string")
    return events.select(
        F.col("user_id").cast("string").alias("stock_ticker"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("string").alias("timestamp"),
        v.alias("open"),
        v.alias("high"),
        v.alias("low"),
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(v).alias("close"),
        F.round(F.col("value") * 100).cast("bigint").cast("string").alias("volume"),
    )


def scd_target_from_customer(customer: DataFrame) -> DataFrame:
    """Versioned dimension: open rows for most keys plus expired history rows."""
    k = F.col("c_custkey")
    base = [k.alias("customer_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("city")]
    open_rows = customer.filter(k % 10 != 0).select(
        *base,
        (k + 1).alias("record_id"),
        ntz(OPEN_START).alias("effective_start_date"),
        ntz(SENTINEL).alias("effective_end_date"),
    )
    expired = customer.filter(k % 7 == 0).select(
        *base,
        (k + 1_000_000).alias("record_id"),
        ntz(EXPIRED_START).alias("effective_start_date"),
        ntz(OPEN_START).alias("effective_end_date"),
    )
    return open_rows.unionByName(expired)


def scd_source_from_customer(customer: DataFrame) -> DataFrame:
    """Incoming snapshot: some keys gone, some new, some moved city."""
    k = F.col("c_custkey")
    return customer.filter(k % 10 != 1).select(
        k.alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(k % 5 == 2, F.lit("MOVED")).otherwise(F.col("c_mktsegment")).alias("city"),
    )


def stock_messages_from_events(events: DataFrame) -> DataFrame:
    """Topic-shaped rows: key, JSON value (binary), broker timestamp."""
    t = ticks_from_events(events)
    body = to_json_value(
        F.col("stock_ticker").cast("string").alias("stock_ticker"),
        "timestamp", "open", "high", "low", "close", "volume",
    )
    return t.select(
        F.col("stock_ticker").cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.col("timestamp"),
        F.col("event_id"),
    )


def vectors_from_embeddings(embeddings: DataFrame) -> DataFrame:
    """Labelled ML vectors: ``label`` double, ``features`` dense vector."""
    from pyspark.ml.functions import array_to_vector

    return embeddings.select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("embedding")).alias("features"),
    )
