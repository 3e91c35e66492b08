"""Bar cleaning, message encoding/decoding, publish ordering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

from quarry.functions.json import parse_json, to_json_value

# The bar columns and their types.
BAR_TYPES = {
    "timestamp": "timestamp",
    "open": "double",
    "high": "double",
    "low": "double",
    "close": "double",
    "volume": "bigint",
}

# Fixed value: the stock message schema.
STOCK_SCHEMA = StructType([
    StructField("stock_ticker", StringType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("open", DoubleType(), True),
    StructField("high", DoubleType(), True),
    StructField("low", DoubleType(), True),
    StructField("close", DoubleType(), True),
    StructField("volume", LongType(), True),
])


def clean_bars(
    raw: DataFrame, types: dict[str, str] | None = None, carry: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Type the bar columns; keep rows where every one is present and parses.

    Returns ``(good, rejected)``. Casting happens before the null test, so a
    value that does not parse rejects its row rather than passing as null or
    failing the job. ``isNotNull`` on the raw columns reaches the scan.
    """
    types = dict(types or BAR_TYPES)
    carry = [c for c in (carry if carry is not None else raw.columns) if c not in types]
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in types])
    typed = {c: F.col(c).try_cast(t) for c, t in types.items()}
    parsed = reduce(lambda a, b: a & b, [e.isNotNull() for e in typed.values()])
    good = raw.where(present).select(*carry, *[e.alias(c) for c, e in typed.items()]).where(
        reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in types])
    )
    rejected = raw.where(~(present & parsed))
    return good, rejected


def load_bars(
    spark, path, ticker_from: str | None = "stem", schema=None, types: dict | None = None
) -> tuple[DataFrame, DataFrame]:
    """Read OHLCV CSV files (header line, one file or folder per ticker).

    The ticker comes from the file: ``stem`` = file name without extension,
    ``dir`` = the folder holding it (the value after ``=`` for ``k=v`` folders).
    Returns ``(good, rejected)`` as ``clean_bars``.
    """
    from quarry.functions.text import file_stem, plain_path
    from quarry.session import list_by_cores
    from quarry.sources.files import BAR_TEXT_SCHEMA, read_csv

    raw = read_csv(list_by_cores(spark), path, schema or BAR_TEXT_SCHEMA, header=True)
    fp = plain_path(F.col("_metadata.file_path"))
    if ticker_from == "stem":
        raw = raw.withColumn("stock_ticker", file_stem(fp))
    elif ticker_from == "dir":
        raw = raw.withColumn("stock_ticker", F.regexp_extract(fp, r"(?:[^/=]+=)?([^/=]+)/[^/]+$", 1))
    elif ticker_from is not None:
        raise ValueError(f"unknown ticker_from {ticker_from!r}")
    return clean_bars(raw, types)


def csv_to_messages(
    spark, path, fieldnames: list[str], header: bool = True, key: str | None = None
) -> DataFrame:
    """Delimited rows with the given field names -> one JSON message per row.

    Every field is read as text (names are explicit, not taken from the file);
    ``header`` skips a header line instead of sending it as data.
    """
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField(n, StringType(), True) for n in fieldnames])
    # positional: the given names win over whatever a header line says
    rows = spark.read.option("header", header).option("enforceSchema", True).schema(schema).csv(path)
    return rows.select(
        (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"),
        to_json_value(*fieldnames).alias("value"),
    )


def publish_order(df: DataFrame, key: str, ts: str, num_partitions: int | None = None, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Group each key's rows in one partition, sorted by time (then ``tiebreak``), for a keyed sink.

    Replaces a global sort: per-key order is all a keyed topic keeps anyway.
    """
    out = df.repartition(num_partitions, key) if num_partitions else df.repartition(key)
    return out.sortWithinPartitions(key, ts, *tiebreak)


def to_messages(df: DataFrame, key: str) -> DataFrame:
    """``key`` string and ``value`` = JSON of the whole row (nulls omitted)."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        to_json_value(*[F.col(c) for c in df.columns]).alias("value"),
    )


def parse_messages(
    df: DataFrame, schema: StructType = STOCK_SCHEMA, value_col: str = "value", key_col: str | None = "key",
    carry: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Topic rows -> (key + ``carry`` columns + message fields, rejected raw values)."""
    keep = list(carry or [])
    if key_col:
        df = df.withColumn(key_col, F.col(key_col).cast("string"))
        keep = [key_col, *keep]
    return parse_json(df, value_col, schema, keep)
