"""Message-topic sources and sinks (Kafka protocol).

The Kafka connector is a separate Spark package; these helpers build the
option maps and frames and leave the connector on the classpath to the
deployment. Logic never depends on the topic: it works on any frame shaped
``key, value (binary or string), timestamp``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_source_options(
    servers: str, topic: str, starting: str = "earliest", max_offsets_per_trigger: int | None = None, **extra
) -> dict:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def topic_sink_options(servers: str, topic: str, **extra) -> dict:
    opts = {"kafka.bootstrap.servers": servers, "topic": topic}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_topic(spark: SparkSession, options: dict, stream: bool = True) -> DataFrame:
    """Rows ``key, value, topic, partition, offset, timestamp, timestampType``."""
    r = spark.readStream if stream else spark.read
    return r.format("kafka").options(**options).load()


def as_topic_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """Project to the two columns a topic sink takes."""
    return df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))


def write_topic(df: DataFrame, options: dict) -> None:
    """Publish a batch frame (``key``, ``value``) once."""
    df.write.format("kafka").options(**options).save()
