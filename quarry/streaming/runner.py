"""Starting streams with explicit sinks, triggers and checkpoints."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


@contextmanager
def _partitions(spark: SparkSession, n: int | None):
    """Use ``n`` shuffle partitions for a stream being started.

    A stateful stream fixes its state partition count at the first start (it
    is recorded in the checkpoint), so size it to the cluster, not to the
    session's batch default. The stream clones the session when it starts,
    so the session's own value is restored right after.
    """
    if not n:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def start(
    df: DataFrame,
    checkpoint: str,
    sink: str = "parquet",
    path: str | None = None,
    mode: str = "append",
    trigger: dict | None = None,
    options: dict | None = None,
    query_name: str | None = None,
    shuffle_partitions: int | None = None,
) -> StreamingQuery:
    """Start ``df`` into a sink: parquet/json/csv (path), kafka (options), memory, console.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (default: as fast as
    possible); use ``{"availableNow": True}`` to drain what exists and stop.
    """
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    w = w.format(sink)
    with _partitions(df.sparkSession, shuffle_partitions):
        return w.start(path) if path else w.start()


def idempotent_batch_writer(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body that writes each micro-batch under ``batch_id=<id>``.

    A retried batch overwrites its own folder, so replays never duplicate rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")

    return write


def start_foreach_batch(
    df: DataFrame,
    checkpoint: str,
    fn: Callable[[DataFrame, int], None],
    mode: str = "update",
    trigger: dict | None = None,
    shuffle_partitions: int | None = None,
) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    if trigger:
        w = w.trigger(**trigger)
    with _partitions(df.sparkSession, shuffle_partitions):
        return w.start()


def latest_per_key(spark: SparkSession, path: str, keys: list[str], fmt: str = "parquet") -> DataFrame:
    """Collapse update-mode output written per batch to the last value per key."""
    df = spark.read.format(fmt).load(path)
    vals = [c for c in df.columns if c not in keys and c != "batch_id"]
    last = F.max_by(F.struct(*vals), F.col("batch_id")).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in vals])


def rows_dropped_by_watermark(query: StreamingQuery) -> int:
    """Late rows discarded by stateful operators, summed over recent progress."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) or []:
            total += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return total
