"""Price/volume anomaly rules over a stream, with history kept across micro-batches.

Two chained stateful operators, so that a ticker holding a third of the stream is not one task's work:

1. *Chunks*: state is keyed by (ticker bucket, time chunk). Bars wait in a map state by time slot until the
   watermark passes them, so a micro-batch reads and writes only the slots it adds to or
   releases. A released bar with ``rows`` bars of its ticker before it in the chunk is complete; the first
   ``rows`` bars of a ticker in a chunk (heads) lack earlier history. When the watermark passes the chunk's end it
   emits each ticker's last close and last ``rows`` volumes (a tail) and drops its state.
2. *Joints*: keyed by (ticker bucket, lane). Heads and tails, at most ``rows`` + 1 per ticker and chunk, meet in
   one lane, where the tails' history completes the heads; complete bars pass through in their chunk's lane
   without touching state.

A head is released only after its chunk began, so the tails of all earlier chunks of its ticker come in the same
micro-batch or before it. Bars that arrive out of order within the watermark delay give the same result as
the batch job. Many tickers share a bucket, so the number of state reads does not grow with the tickers of a
micro-batch. Needs the RocksDB state store provider.
"""

from __future__ import annotations

import json
import sys as _sys

from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quarry.operators.ticks import VOLUME_ROWS, apply_rules
from quarry.session import ROCKSDB_PROVIDER, ship_package

# Workers (including Spark's driver-side Python runner for stateful
# processors) unpickle this module's classes and functions by value, so they
# do not need the package installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

CHUNK_SECONDS = 86_400
BUCKETS = 64
SLOTS = 8  # time slots of a chunk in which bars wait
COMPLETE, HEAD, TAIL = 0, 1, 2
_BAR = ["ticker", "ts_us", "tb", "close", "volume"]
_JOINT_SCHEMA = ("bucket int, chunk long, kind int, ticker string, ts_us long, tb long, close double, volume double, "
                 "prev double, average double, vols array<double>, event_time timestamp")
# The row form hands bars on in packs: Spark turns all rows that a task's timers emit in a micro-batch into
# one batch of Python dictionaries, so a row a bar would hold every bar the watermark releases.
_PACK_ROWS = 1000
_PACK_SCHEMA = "bucket int, chunk long, packed string, event_time timestamp"
_PACKED = ("array<struct<kind:int,ticker:string,ts_us:bigint,tb:bigint,close:double,volume:double,prev:double,"
           "average:double,vols:array<double>>>")
_OUT_SCHEMA = "ticker string, ts_us long, tb long, close double, volume double, prev double, average double"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _mean(vols: list) -> float | None:
    known = [v for v in vols if v is not None and v == v]
    return sum(known) / len(known) if known else None


class _Processor(StatefulProcessor):
    """Rows as tuples in and out, for the row and the pandas form of ``transformWithState``."""

    names: list[str]

    def __init__(self, rows: int, row_api: bool):
        self.rows = rows
        self.row_api = row_api

    def _tuples(self, rows, names: list[str]) -> list[list]:
        if self.row_api:
            return [[r[c] for c in names] for r in rows]
        out = []
        for pdf in rows:  # pandas has no missing value but NaN in number columns
            out += [[None if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else v for v in r]
                    for r in pdf[names].astype(object).itertuples(index=False, name=None)]
        return out

    def _parts(self, rows) -> Iterator[list]:
        """``rows`` in lists of 1,000 rows, or of one frame."""
        rows = iter(rows)
        while some := list(islice(rows, 1000 if self.row_api else 1)):
            yield some

    def _emit(self, out: list[tuple]) -> Iterator:
        if not out:
            return iter([])
        if self.row_api:
            row = Row(*self.names)
            return iter([row(*r) for r in out])
        return iter([pd.DataFrame(out, columns=self.names)])

    def close(self) -> None:
        pass


class ChunkHistory(_Processor):
    """First operator: one key is a ticker bucket in a time chunk.

    ``head`` holds, as JSON, the slots with waiting bars, the pending timer and per ticker
    [last close, last volumes, bars released]; ``slots`` the waiting bars of each slot.
    """

    names = _names(_JOINT_SCHEMA)

    def __init__(self, rows: int, row_api: bool, chunk_us: int):
        super().__init__(rows, row_api)
        self.chunk_us = chunk_us
        self.slot_us = max(1, chunk_us // SLOTS)

    def _emit(self, out: list[tuple]) -> Iterator:
        if not self.row_api:
            return super()._emit(out)
        row, names, packs = Row(*_names(_PACK_SCHEMA)), self.names[2:-1], []
        for i in range(0, len(out), _PACK_ROWS):
            some = out[i:i + _PACK_ROWS]
            packed = json.dumps([dict(zip(names, r[2:-1])) for r in some])
            packs.append(row(some[0][0], some[0][1], packed, min(r[-1] for r in some)))
        return iter(packs)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "body STRING")
        self.slots = handle.getMapState("slots", "slot BIGINT", "bars STRING")

    def _load(self) -> tuple[list, int | None, dict]:
        got = self.head.get()
        return json.loads(got[0]) if got is not None else ([], None, {})

    def _step(self, key, new: list[list], wm_ms: int, timer_fired: bool) -> Iterator:
        bucket, chunk = int(key[0]), int(key[1])
        waiting, timer, held = self._load()
        if not (new or waiting or held):
            return iter([])
        limit, start = wm_ms * 1000, chunk * self.chunk_us
        ready, rest = [], {}
        for bar in new:
            if bar[1] < limit:
                ready.append(bar)
            else:
                rest.setdefault((bar[1] - start) // self.slot_us, []).append(bar)
        earliest = None
        for slot in list(waiting):  # slots the watermark has not reached are left alone unless bars join them
            due = start + slot * self.slot_us < limit
            if not (due or slot in rest):
                continue
            bars = json.loads(self.slots.getValue((slot,))[0])
            stay = [b for b in bars if b[1] >= limit]
            ready += [b for b in bars if b[1] < limit]
            if stay or slot in rest:
                rest[slot] = stay + rest.get(slot, [])
            else:
                self.slots.removeKey((slot,))
                waiting.remove(slot)
        for slot, bars in rest.items():
            self.slots.updateValue((slot,), (json.dumps(bars),))
            if slot not in waiting:
                waiting.append(slot)
        if waiting:
            first = min(waiting)
            earliest = min(b[1] for b in rest[first]) if first in rest else start + first * self.slot_us
        out = self._release(bucket, chunk, ready, held)
        end_ms = (start + self.chunk_us) // 1000
        if not waiting and wm_ms >= end_ms:
            at = pd.Timestamp(end_ms, unit="ms", tz="UTC")
            for ticker, (prev, vols, n) in held.items():
                out.append((bucket, chunk, TAIL, ticker, n, None, None, None, prev, None, vols, self._time(at)))
            self.head.clear()
            self.slots.clear()
            return self._emit(out)
        # a slot's earliest bar, or the chunk's end once none waits; a slot not read is due at its start
        at = earliest // 1000 + 1 if earliest is not None else end_ms
        if timer is None or timer_fired or at != timer:
            at = max(at, wm_ms + 1)
            self.handle.registerTimer(at)
            timer = at
        self.head.update((json.dumps((waiting, timer, held)),))
        return self._emit(out)

    def _time(self, at: pd.Timestamp):
        return at.to_pydatetime().replace(tzinfo=None) if not self.row_api else at.to_pydatetime()

    def _release(self, bucket: int, chunk: int, ready: list, held: dict) -> list[tuple]:
        out = []
        for ticker, ts, tb, close, volume in sorted(ready, key=lambda b: (b[0], b[1], b[2] is not None, b[2])):
            prev, vols, n = held.get(ticker, (None, [], 0))
            when = self._time(pd.Timestamp(ts, unit="us", tz="UTC"))
            if n >= self.rows:
                out.append((bucket, chunk, COMPLETE, ticker, ts, tb, close, volume, prev, _mean(vols), None, when))
            else:
                out.append((bucket, chunk, HEAD, ticker, ts, tb, close, volume, None, None, None, when))
            held[ticker] = (close, (vols + [volume])[-self.rows:], n + 1)
        return out

    def handleInputRows(self, key, rows, timerValues):
        bars = [[b[0], int(b[1]), None if b[2] is None else int(b[2]), b[3], b[4]] for b in self._tuples(rows, _BAR)]
        return self._step(key, bars, timerValues.getCurrentWatermarkInMs(), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return self._step(key, [], timerValues.getCurrentWatermarkInMs(), True)


class ChunkJoints(_Processor):
    """Second operator: completes the heads of a bucket's tickers from the tails of their earlier chunks.

    State, as JSON per bucket: ticker -> [last close, last volumes, open chunk, heads seen in it as (close, volume)].
    """

    names = _names(_OUT_SCHEMA)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("joints", "body STRING")

    def handleInputRows(self, key, rows, timerValues):
        if int(key[1]) >= 0:  # a lane of complete bars, handed on as they come
            return (out for some in self._parts(rows) for out in self._emit([tuple(r) for r in self._tuples(some, self.names)]))
        got = self._tuples(rows, ["chunk", "kind", "ticker", "ts_us", "tb", "close", "volume", "prev", "average", "vols"])
        old = self.state.get()
        joints = json.loads(old[0]) if old is not None else {}
        out = []
        got.sort(key=lambda r: (r[2], r[0], r[1], r[3], r[4] is not None, r[4]))
        for chunk, kind, ticker, ts, tb, close, volume, prev, _, vols in got:
            last, past, open_, seen = joints.get(ticker, (None, [], None, []))
            if kind == HEAD:
                if open_ != chunk:
                    seen = []
                have = (past + [v for _, v in seen])[-self.rows:]
                out.append((ticker, int(ts), None if tb is None else int(tb), close, volume, seen[-1][0] if seen else last, _mean(have)))
                joints[ticker] = (last, past, int(chunk), seen + [(close, volume)])
            else:
                vols = [None if v is None or v != v else float(v) for v in vols]
                joints[ticker] = (prev, vols if ts >= self.rows else (past + vols)[-self.rows:], None, [])
        self.state.update((json.dumps(joints),))
        return self._emit(out)


def incomplete(ticks: DataFrame, key: str = "stock_ticker", ts: str = "timestamp") -> DataFrame:
    """The bars that ``detect_anomalies_stream`` leaves out: no event time or no ticker."""
    return ticks.where(F.col(ts).isNull() | F.col(key).isNull())


def detect_anomalies_stream(
    ticks: DataFrame,
    watermark: str,
    key: str = "stock_ticker",
    ts: str = "timestamp",
    tiebreak: str = "event_id",
    rows: int = VOLUME_ROWS,
    price_pct: float | None = None,
    volume_pct: float | None = None,
    row_api: bool = True,
    chunk_seconds: int = CHUNK_SECONDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming form of ``quarry.operators.ticks.detect_anomalies``.

    ``ticks`` is a streaming frame with an event-time ``ts`` (TIMESTAMP type),
    ``key``, ``tiebreak``, ``close`` and ``volume``. Output is append-only and
    delayed by ``watermark``; bars later than the watermark are dropped by Spark.
    ``chunk_seconds`` is the time span that one task holds of a ticker (choose it so that a ticker has
    many times ``rows`` bars in it), ``buckets`` the number of ticker groups (a task's Python holds the bars of one
    group in one chunk: choose it so that these are some tens of thousands); both are
    fixed at the first start, like the state partitions. ``row_api`` uses the row-based
    ``transformWithState``, otherwise ``transformWithStateInPandas``.
    """
    spark = ticks.sparkSession
    ship_package(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    key_type = ticks.schema[key].dataType
    chunk_us = int(chunk_seconds) * 1_000_000
    t_us = F.unix_micros(F.col(ts))
    # A bar without a time or a ticker has no place in any series; ``incomplete`` returns such bars.
    inp = ticks.where(F.col(ts).isNotNull() & F.col(key).isNotNull()).withWatermark(ts, watermark).select(
        F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int").alias("bucket"),
        F.floor(t_us / chunk_us).cast("long").alias("chunk"),
        ts,
        F.col(key).cast("string").alias("ticker"),
        t_us.alias("ts_us"),
        F.col(tiebreak).cast("bigint").alias("tb"),
        F.col("close").cast("double").alias("close"),
        F.col("volume").cast("double").alias("volume"),
    )

    def stage(frame: DataFrame, by: list[str], processor: StatefulProcessor, schema: str, mode: str, event_time: str = "") -> DataFrame:
        grouped = frame.groupBy(*by)
        run = grouped.transformWithState if row_api else grouped.transformWithStateInPandas
        return run(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode=mode, eventTimeColumnName=event_time)

    parts = stage(inp, ["bucket", "chunk"], ChunkHistory(rows, row_api, chunk_us), _PACK_SCHEMA if row_api else _JOINT_SCHEMA,
                  "EventTime", "event_time")
    if row_api:
        parts = parts.select("event_time", "bucket", "chunk", F.explode(F.from_json("packed", _PACKED)).alias("bar")).select(
            "event_time", "bucket", "chunk", "bar.*")
    lane = F.when(F.col("kind") == COMPLETE, F.col("chunk").bitwiseAND(F.lit((1 << 62) - 1))).otherwise(F.lit(-1))
    hist = stage(parts.withColumn("lane", lane).drop("event_time"), ["bucket", "lane"], ChunkJoints(rows, row_api), _OUT_SCHEMA, "None")
    hist = hist.select(
        F.col("ticker").cast(key_type).alias(key),
        F.timestamp_micros("ts_us").alias(ts),
        F.col("tb").alias(tiebreak),
        "close",
        F.col("volume").cast(ticks.schema["volume"].dataType).alias("volume"),
        F.col("prev").alias("prev_minute_close"),
        F.col("average").alias("avg_10min_volume"),
    )
    kw = {}
    if price_pct is not None:
        kw["price_pct"] = price_pct
    if volume_pct is not None:
        kw["volume_pct"] = volume_pct
    return apply_rules(hist, **kw)


def per_batch_alert_writer(alerts_path: str, **rule_args):
    """``foreachBatch`` body that applies the batch rules to each micro-batch alone.

    History does not cross micro-batch boundaries here (the first bar of each
    batch has none); use ``detect_anomalies_stream`` to keep it. Empty batches
    are skipped without a count; each batch's alerts go to ``batch_id=<id>``
    with overwrite, so a retried batch replaces its own output.
    """
    from quarry.operators.ticks import alert_messages, detect_anomalies

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        flagged = detect_anomalies(batch, chunk="auto", **rule_args)
        alert_messages(flagged).write.mode("overwrite").json(f"{alerts_path}/batch_id={batch_id}")

    return write
