"""Model inference over files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from quarry.operators.inference import PREDICTION_SCHEMA, classify
from quarry.session import list_by_cores
from quarry.streaming.runner import start

# Fixed value: the binary-file source schema.
BINARY_FILE_SCHEMA = StructType([
    StructField("path", StringType(), False),
    StructField("modificationTime", TimestampType(), False),
    StructField("length", LongType(), False),
    StructField("content", BinaryType(), True),
])


def classified_files(
    spark: SparkSession,
    source_dir: str,
    model_factory,
    preprocess,
    decode,
    schema: str = PREDICTION_SCHEMA,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    label_pattern: str | None = None,
) -> DataFrame:
    """Streaming frame ``label, prediction, processing_time`` (+ ``path``).

    The label is the folder holding each file, or the first group of
    ``label_pattern`` applied to the path. Each micro-batch takes at most
    ``max_files_per_trigger`` new files (default: all there are).
    """
    r = list_by_cores(spark).readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    files = r.load(source_dir)
    out = classify(files, "content", model_factory, preprocess, decode, schema,
                   label_from_path=None if label_pattern else "path", with_time=True)
    if label_pattern:
        out = out.withColumn("label", F.regexp_extract("path", label_pattern, 1))
    return out.select("path", "label", "prediction", "processing_time")


def classify_stream(
    spark: SparkSession,
    source_dir: str,
    checkpoint: str,
    model_factory,
    preprocess,
    decode,
    sink: str = "console",
    path: str | None = None,
    trigger: dict | None = None,
    **kw,
) -> StreamingQuery:
    """Start the classifier; append mode, one row per file."""
    df = classified_files(spark, source_dir, model_factory, preprocess, decode, **kw)
    if sink == "console":
        df = df.drop("path")
    return start(df, checkpoint, sink=sink, path=path, mode="append", trigger=trigger,
                 options={"truncate": "false"} if sink == "console" else None)
