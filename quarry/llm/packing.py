"""Packing of tokenised documents into sequences: vector bin packing with the dot-product heuristic.

A piece has three demands: tokens, one segment, and loss-bearing tokens (those after the prompt).
A sequence has a capacity in each. While a sequence is open, the pooled piece that fits and has the
largest dot product of demand and free room, both as shares of capacity, is placed next. When none
fits, the piece with the largest product is cut to the room left, if both parts keep ``MIN_PIECE``
tokens; its rest returns to the pool. Each input partition packs its own rows: no text is shuffled,
the pool is bounded (a window for choosing, not a cap on rows), and only the last sequences of a
partition carry padding. A lost task is repeated whole, so its sequences stay consistent; the input's
partitions must be reproducible (a table scan, or a pinned frame).

Defined cases: null text and null prompt are empty, so a document is at least its end id; null or
repeated ids are packed like any row; an empty table gives no pieces; a document of any length is
cut into as many pieces as needed; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ready
from .tokens import Encoder

MIN_PIECE = 16


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048


class Packer:
    """Fills sequences from a pool of pieces; ``emit`` gets (sequence, offset, item, start, length)."""

    def __init__(self, limits: Limits, pool: int, emit):
        self.capacity = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.limits, self.pool, self.emit = limits, pool, emit
        self.demand = np.zeros((2 * pool + 2, 3))
        self.items: list = []
        self.sequence = 0

    def _longest(self, start: int, end: int, prompt: int, tokens: int, loss: int) -> int:
        """Longest run from ``start`` within so many tokens and loss-bearing tokens."""
        return min(end - start, tokens, max(prompt - start, 0) + loss)

    def _loss(self, start: int, end: int, prompt: int) -> int:
        return max(0, end - max(start, prompt))

    def add(self, item, length: int, prompt: int) -> None:
        """Place a document; ``item`` is (document, ids, place of the first of these ids, ids in all)."""
        start, lim = 0, self.limits
        while start < length:
            n = self._longest(start, length, prompt, lim.tokens, lim.loss_tokens)
            if n == lim.tokens or n < length - start:  # a sequence of its own
                self.emit(self.sequence, 0, item, start, n)
                self.sequence += 1
                start += n
            else:
                doc, ids, _, total = item
                self._push((doc, ids[4 * start:], start, total), start, length, prompt)  # the rest of the ids is let go
                break
        if len(self.items) >= 2 * self.pool:
            while len(self.items) > self.pool:
                self._fill()

    def _push(self, item, start: int, end: int, prompt: int) -> None:
        self.demand[len(self.items)] = (end - start, 1, self._loss(start, end, prompt))
        self.items.append((item, start, end, prompt))

    def _take(self, i: int):
        out, last = self.items[i], len(self.items) - 1
        self.items[i] = self.items[last]
        self.demand[i] = self.demand[last]
        self.items.pop()
        return out

    def _fill(self) -> None:
        free, offset = self.capacity.copy(), 0
        while self.items and free[0] > 0 and free[1] > 0:
            d = self.demand[:len(self.items)]
            score = (d / self.capacity) @ (free / self.capacity)
            fits = (d <= free).all(axis=1)
            if fits.any():
                item, start, end, prompt = self._take(int(np.argmax(np.where(fits, score, -1.0))))
            else:
                i = int(np.argmax(score))
                item, start, end, prompt = self.items[i]
                n = self._longest(start, end, prompt, int(free[0]), int(free[2]))
                if n < MIN_PIECE or end - start - n < MIN_PIECE:
                    break
                self._take(i)
                self._push(item, start + n, end, prompt)
                end = start + n
            self.emit(self.sequence, offset, item, start, end - start)
            offset += end - start
            free -= (end - start, 1, self._loss(start, end, prompt))
        self.sequence += 1

    def close(self) -> None:
        while self.items:
            self._fill()


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, limits: Limits = Limits(), id_col: str = "doc_id",
         text_col: str = "text", prompt_col: str | None = None, end_id: int = 1, pool: int = 256,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (, ids).

    A document is prompt ids, text ids, ``end_id``; only what follows the prompt bears loss.
    """
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType)]
                          + [T.StructField(n, T.LongType()) for n in names[1:7]]
                          + [T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids)
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(tokenizer_path, pattern)
        base = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def emit(sequence, offset, item, start, length):
            doc, ids, at, total = item
            part = ids[4 * (start - at):4 * (start - at + length)]
            row = (doc, start, length, zlib.crc32(part), total, base + sequence, offset)
            rows.append(row + (np.frombuffer(part, "<u4").astype(np.int64),) if with_ids else row)

        def flush():
            cols = list(zip(*rows)) or [[]] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        packer = Packer(limits, pool, emit)
        types = None
        for batch in batches:
            types = types or [batch.schema.field(0).type] + [pa.int64()] * 6 + [pa.list_(pa.int64())] * with_ids
            for i in range(0, batch.num_rows, 128):
                doc, prompt, text = (c.to_pylist() for c in batch.slice(i, 128).columns)
                for d, p, t in zip(doc, prompt, text):
                    before = enc.ids(p) if p else b""
                    ids = before + (enc.ids(t) if t else b"") + end
                    packer.add((d, ids, 0, len(ids) // 4), len(ids) // 4, len(before) // 4)
                if len(rows) >= 4096:
                    yield flush()
        if types:
            packer.close()
            yield flush()

    prompt = F.col(prompt_col).cast("string") if prompt_col else F.lit(None).cast("string")
    src = ready(docs).select(F.col(id_col).alias("id"), prompt.alias("prompt"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)
