"""Stupid-backoff scores from n-gram counts partitioned by hash.

Tasks pack the documents they read into compressed blocks. A block sends each distinct n-gram (orders 1 to
``order``, as a 64-bit hash) once, with its count, to the n-gram's shard, packed in arrays: hashes sorted and
as differences, a shard being a range of hashes. The shard sums the corpus's counts, drops n-grams of order 2
and more below ``cutoff``, and answers each block with the counts of the n-grams it sent. The block joins the
counts to its exploded n-grams and sums per document:

    S(w | history) = count(history w) / count(history) if count(history w) >= cutoff, else
                     backoff * S(w | shorter history); S(w) = count(w) / total words.

A word in every document is one entry per block. Blocks and shards are as many as the data need; texts
are shuffled once, in their blocks, never collected.

Defined cases: null and empty texts have no words, score 0 and a null perplexity; null ids and repeated
rows are scored like any row, and repeated rows count in the corpus as often as they occur; a word that
the corpus lacks counts as one half; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import estimate_partitions

from . import textkernel as K
from .common import blocks_of, loosen, rows_of, squeeze

ORDER, CUTOFF, BACKOFF = 3, 2, 0.4
BLOCK_BYTES = 8 << 20


def _grams(texts, order: int):
    """(woff, [hashes of the n-gram that ends at each word, or 0 where history is too short], per order)."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    woff, hashes = [np.zeros(1, np.int64)], []
    for _, data, offs in K.text_chunks(batch):
        s, e, w = K.words(data, offs)
        hashes.append(K.FIRST.ranges(K.FIRST.prefix(data), s, e))
        woff.append(w[1:] + woff[-1][-1])
    woff = np.concatenate(woff)
    wh = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    place = np.arange(len(wh)) - np.repeat(woff[:-1], np.diff(woff))
    out = []
    for n in range(1, order + 1):
        g = np.zeros(len(wh), np.uint64)
        at = np.flatnonzero(place >= n - 1)
        g[at] = K.combine(wh, n, at - (n - 1))
        out.append(g)
    return woff, place, out


def _distinct(grams, place, order: int, shards: int):
    """Sorted distinct n-grams with counts and orders, and the cuts between shards."""
    u, o, c = [], [], []
    for n, g in enumerate(grams, 1):
        x, k = np.unique(g[place >= n - 1], return_counts=True)
        u.append(x)
        c.append(k)
        o.append(np.full(len(x), n, np.uint8))
    u, c, o = (np.concatenate(x) for x in (u, c, o))
    by = np.argsort(u)
    u = u[by]
    shard = (u >> K.U64(32)) * K.U64(shards) >> K.U64(32)
    return u, c[by].astype("<i8"), o[by], np.searchsorted(shard, np.arange(shards + 1).astype(np.uint64))


def _sent(texts, order: int, shards: int) -> dict:
    """Columns of what a block sends: its distinct n-grams, one row per shard."""
    _, place, grams = _grams(texts, order)
    u, c, o, cut = _distinct(grams, place, order, shards)
    some = np.flatnonzero(np.diff(cut))
    parts = [slice(cut[i], cut[i + 1]) for i in some]
    return {"shard": pa.array(some, pa.int32()), "n": pa.array(np.diff(cut)[some], pa.int32()),
            "gram": pa.array([squeeze(np.diff(u[p], prepend=K.U64(0))) for p in parts], pa.binary()),
            "count": pa.array([squeeze(c[p]) for p in parts], pa.binary()),
            "single": pa.array([np.packbits(o[p] == 1).tobytes() for p in parts], pa.binary())}


def _totals(gram: np.ndarray, count: np.ndarray, size: np.ndarray, cutoff: int) -> np.ndarray:
    """The corpus's 64-bit count of each n-gram sent; 0 for orders of 2 and more below ``cutoff``."""
    u, back = np.unique(gram, return_inverse=True)
    total = np.zeros(len(u), np.int64)
    np.add.at(total, back, count)
    total = total[back]
    total[(size > 1) & (total < cutoff)] = 0
    return total


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, cutoff: int = CUTOFF,
          backoff: float = BACKOFF, blocks: int | None = None) -> DataFrame:
    """Per document: id, n_words, log_score (natural log, summed over words), perplexity. The corpus is ``docs``."""
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = blocks or max(least, estimate_partitions(docs, BLOCK_BYTES // 2))  # files hold about half a text's bytes
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    packed = blocks_of(src, "text", BLOCK_BYTES).repartition("block")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                cols = _sent(rows_of(rows.as_buffer())["text"].combine_chunks(), order, shards)
                ids = pa.array(np.full(len(cols["shard"]), block), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, *cols.values()], ["block", *cols])

    def answer(rows: pa.Table) -> pa.Table:
        n = rows["n"].to_pylist()
        gram = np.concatenate([np.cumsum(loosen(x.as_buffer(), k, "<u8"), dtype=np.uint64) for x, k in zip(rows["gram"], n)])
        count = np.concatenate([loosen(x.as_buffer(), k, "<i8") for x, k in zip(rows["count"], n)])
        size = np.concatenate([2 - np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=k) for x, k in zip(rows["single"], n)])
        total = _totals(gram, count, size, cutoff)
        told = [squeeze(np.ascontiguousarray(x)) for x in np.split(total, np.cumsum(n)[:-1])]
        return pa.table({"block": rows["block"], "shard": rows["shard"], "n": rows["n"], "count": pa.array(told, pa.binary())})

    sent = packed.mapInArrow(send, "block long, shard int, n int, gram binary, count binary, single binary")
    told = sent.groupBy("shard").applyInArrow(answer, "block long, shard int, n int, count binary")
    words = src.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("log_score", T.DoubleType()), T.StructField("perplexity", T.DoubleType())])

    def total(blocks: pa.Table, counts: pa.Table) -> pa.Table:
        (rows,) = map(rows_of, (x.as_buffer() for x in blocks["rows"]))
        woff, place, grams = _grams(rows["text"].combine_chunks(), order)
        u, _, _, cut = _distinct(grams, place, order, shards)
        held = np.full(len(u), -1)
        for s, n, c in zip(counts["shard"].to_pylist(), counts["n"].to_pylist(), counts["count"]):
            held[cut[s]:cut[s + 1]] = loosen(c.as_buffer(), n, "<i8")
        if (held < 0).any():
            raise RuntimeError("a block changed between its two reads")
        of = []  # the corpus's count of each n-gram, by place of its last word
        for n, g in enumerate(grams, 1):
            at = np.flatnonzero(place >= n - 1)
            code, own = pd.factorize(g[at])
            by = np.argsort(own)  # sorted look-ups walk through memory in order
            count = np.empty(len(own), np.int64)
            count[by] = held[np.searchsorted(u, own[by])]
            of.append(np.zeros(len(place), np.int64))
            of[-1][at] = count[code]
        log = np.zeros(len(place))
        todo = np.ones(len(place), bool)
        start = np.minimum(place + 1, order)
        for n in range(order, 0, -1):
            at = np.flatnonzero(todo & (place >= n - 1))
            c = of[n - 1][at]
            ok = c > 0 if n > 1 else np.ones(len(at), bool)
            at, c = at[ok], c[ok]
            base = of[n - 2][at - 1] if n > 1 else np.full(len(at), words)
            log[at] = np.log(np.maximum(c, 0.5) / np.maximum(base, 1)) + (start[at] - n) * np.log(backoff)
            todo[at] = False
        nw = np.diff(woff)
        c = np.concatenate(([0.0], np.cumsum(log)))
        sums = c[woff[1:]] - c[woff[:-1]]
        perplexity = pa.array(np.exp(-sums / np.maximum(nw, 1)), mask=nw == 0)
        return pa.Table.from_arrays([rows["id"], pa.array(nw, pa.int64()), pa.array(sums), perplexity], schema.names)

    return packed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(total, schema)
