"""Late rows to a sink of their own, split off before a stateful step drops them.

Spark drops rows older than the watermark inside its stateful operators and only counts them. ``gate_stream``
stands before such a stream: each micro-batch is split by the event times seen in earlier micro-batches, rows that
are on time are written to one folder, which the stateful stream reads as its source, and the others to a second one with a
reason. A stateful stream with the same delay over the on-time folder drops nothing, since its own
watermark never passes the gate's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.streaming.runner import start_foreach_batch


def split_late(batch: DataFrame, ts: str, latest_us: int | None, delay_seconds: float) -> tuple[DataFrame, DataFrame]:
    """(on time, late with ``reason``): late rows have no time or lie before the latest time seen minus the delay."""
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    reason = F.when(t.isNull(), F.lit("no time"))
    if latest_us is not None:
        reason = reason.when(t < F.lit(latest_us - int(delay_seconds * 1_000_000)), F.lit("late"))
    marked = batch.withColumn("reason", reason)
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def gate_stream(
    stream: DataFrame,
    ts: str,
    delay_seconds: float,
    on_time_path: str,
    late_path: str,
    marks_path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Split ``stream`` into ``on_time_path`` and ``late_path``, a folder per micro-batch (``batch_id=<id>``).

    ``marks_path`` gets one row per micro-batch, the latest event time up to it. A repeated micro-batch reads the
    marks before its own and overwrites its folders, so it splits its rows as it did before.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id > 0:
            seen = spark.read.schema("latest_us long, batch_id long").parquet(marks_path).where(F.col("batch_id") < batch_id)
            latest = seen.agg(F.max("latest_us")).first()[0]
        else:
            latest = None
        batch = batch.persist()  # one read of the source for the three outputs
        try:
            on_time, late = split_late(batch, ts, latest, delay_seconds)
            on_time.write.mode("overwrite").parquet(f"{on_time_path}/batch_id={batch_id}")
            late.write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
            mark = batch.agg(F.greatest(F.max(F.unix_micros(F.col(ts).cast("timestamp"))), F.lit(latest).cast("long")).alias("latest_us"))
            mark.write.mode("overwrite").parquet(f"{marks_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return start_foreach_batch(stream, checkpoint, write, mode="append", trigger=trigger)
