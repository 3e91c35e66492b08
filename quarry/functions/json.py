"""JSON message encoding and decoding with a reject side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"

# Timestamp text in messages keeps microseconds (Spark's default
# JSON format stops at milliseconds and would lose precision on a round trip).
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_json_value(*cols: str | Column) -> Column:
    """One JSON object per row from the given columns (nulls omitted)."""
    return F.to_json(F.struct(*cols), JSON_OPTIONS)


def parse_json(
    df: DataFrame, value_col: str, schema: StructType, keep: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Parse a JSON text (or binary) column into ``schema`` fields.

    Returns ``(good, rejected)``: rows whose text is not a JSON object of the
    schema go to ``rejected`` with the raw text, instead of becoming all-null rows.
    """
    keep = list(keep or [])
    with_corrupt = StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
    raw = F.col(value_col).cast("string")
    msg = F.from_json(
        raw, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **JSON_OPTIONS}
    )
    # Parse once per row. Produced by a generator, `_msg` cannot be substituted
    # into the reject filter below, which would otherwise evaluate the parse
    # (and whatever built the text) again for every row.
    parsed = df.select(*keep, F.inline(F.array(F.struct(raw.alias("_raw"), msg.alias("_msg")))))
    bad = F.col("_raw").isNull() | F.col("_msg").isNull() | F.col(f"_msg.{CORRUPT}").isNotNull()
    good = parsed.filter(~bad).select(*keep, *[F.col(f"_msg.{f.name}").alias(f.name) for f in schema.fields])
    rejected = parsed.filter(bad).select(*keep, F.col("_raw").alias("raw_value"))
    return good, rejected
