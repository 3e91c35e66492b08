"""Sliding event-time counts over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.sliding import sliding_counts
from quarry.streaming.runner import idempotent_batch_writer, start, start_foreach_batch


def sliding_counts_stream(
    stream: DataFrame,
    checkpoint: str,
    ts: str = "timestamp",
    size: str = "10 seconds",
    slide: str = "5 seconds",
    watermark: str | None = "1 minute",
    mode: str = "update",
    path: str | None = None,
    sink: str = "console",
    trigger: dict | None = None,
    shuffle_partitions: int | None = None,
) -> StreamingQuery:
    """Start the sliding count on ``stream``.

    ``update`` emits a window again whenever it changes: with a ``path`` each
    micro-batch is written under ``batch_id=<id>`` (idempotent on retry) and
    ``quarry.streaming.runner.latest_per_key`` gives the current counts.
    ``append`` (needs a watermark) emits each window once, when it closes.
    ``shuffle_partitions`` fixes the state partition count at the first start.
    """
    counts = sliding_counts(stream, ts, size, slide, watermark)
    if mode == "update" and path:
        return start_foreach_batch(counts, checkpoint, idempotent_batch_writer(path), "update", trigger,
                                   shuffle_partitions)
    return start(counts, checkpoint, sink=sink, path=path, mode=mode, trigger=trigger,
                 options={"truncate": "false"} if sink == "console" else None,
                 shuffle_partitions=shuffle_partitions)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    from quarry.streaming.runner import latest_per_key

    return latest_per_key(spark, path, ["window_start", "window_end"])
