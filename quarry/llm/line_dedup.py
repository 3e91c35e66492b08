"""Line deduplication through a sharded minimal perfect hash over repeated lines.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased. Blocks of documents
are reduced to one entry per key (smallest and largest id, occurrences) and sent to the key's shard as
packed arrays. A shard keeps the keys held by at least two documents and builds a minimal perfect
hash over their 128-bit digests (levels of bit arrays, rank by population count) that indexes compact
arrays: fingerprint, count and owner, the smallest id. Documents probe those arrays; lines are not
joined. While the arrays of all shards fit ``BROADCAST_BYTES`` every task probes its own copy; beyond
that each block's distinct keys go to their shards to be probed there, and the verdicts come back by
document. Both ways give the same rows.

A line in a third of all documents is one entry per block. Keys shorter than ``MIN_CHARS`` code points
are never dropped.

Defined cases: null and empty texts are one empty line; rows without an id hold no line and lose none;
rows with the same id are one document and lose the same lines; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import estimate_partitions

from . import textkernel as K
from .common import pin, ready

MIN_CHARS = 10
BROADCAST_BYTES = 64 << 20
BLOCK_LINES = 400_000
_ENTRY = [("h1", "<u8"), ("h2", "<u8"), ("low", "<i8"), ("high", "<i8"), ("rows", "<i8")]
_ENTRY_SCHEMA = "shard int, " + ", ".join(f"{n} binary" for n, _ in _ENTRY)
_INDEX_SCHEMA = "shard int, keys long, levels array<binary>, fingerprint binary, count binary, owner binary"


class PerfectHash:
    """Minimal perfect hash over distinct (h1, h2) pairs: key -> 0..n-1; unknown keys give any index or -1."""

    MAX_LEVELS = 48

    def __init__(self, levels: list[tuple[int, np.ndarray]]):
        """``levels``: (size, packed bits) each; kept packed, with one rank per 64-bit word."""
        self.sizes = [n for n, _ in levels]
        self.words = [np.concatenate((x, np.zeros(-len(x) % 8, np.uint8))).view(">u8").astype(np.uint64) for _, x in levels]
        counts = [np.bitwise_count(w) for w in self.words]
        self.ranks = [(np.cumsum(c, dtype=np.int64) - c).astype(np.uint32) for c in counts]
        self.before = np.concatenate(([0], np.cumsum([int(c.sum(dtype=np.int64)) for c in counts]))).astype(np.int64)

    @staticmethod
    def _at(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        return (K.mix(h1 + h2 * K.U64(2 * level + 3)) % K.U64(size)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> "PerfectHash":
        levels = []
        while len(h1):
            if len(levels) == cls.MAX_LEVELS:
                raise ValueError("keys are not distinct")
            size = 2 * len(h1) + 8
            at = cls._at(h1, h2, len(levels), size)
            hits = np.bincount(at, minlength=size)
            levels.append((size, np.packbits(hits == 1)))
            rest = hits[at] > 1
            h1, h2 = h1[rest], h2[rest]
        return cls(levels)

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.full(len(h1), -1, np.int64)
        open_ = np.arange(len(h1))
        for i, (size, words) in enumerate(zip(self.sizes, self.words)):
            at = self._at(h1[open_], h2[open_], i, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            held = words[word]
            hit = ((held >> (K.U64(63) - bit)) & K.U64(1)).astype(bool)
            below = np.bitwise_count((held >> K.U64(1)) >> (K.U64(63) - bit)).astype(np.int64)  # the word's bits before it
            out[open_[hit]] = (self.before[i] + self.ranks[i][word] + below)[hit]
            open_ = open_[~hit]
        return out

    def to_rows(self) -> list[bytes]:
        return [n.to_bytes(8, "little") + w.astype(">u8").tobytes()[:(n + 7) // 8] for n, w in zip(self.sizes, self.words)]

    @classmethod
    def from_rows(cls, rows) -> "PerfectHash":
        return cls([(int.from_bytes(r[:8], "little"), np.frombuffer(r, np.uint8, offset=8)) for r in rows])


class Shard:
    """Perfect hash with its arrays; ``owners`` gives the owner of each known key."""

    def __init__(self, row):
        self.hash = PerfectHash.from_rows(row["levels"])
        self.fingerprint = np.frombuffer(row["fingerprint"], "<u8")
        self.owner = np.frombuffer(row["owner"], "<i8")

    def owners(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.hash.find(h1, h2)
        known = at >= 0
        known[known] = self.fingerprint[at[known]] == h2[known]
        return known, np.where(known, self.owner[np.where(known, at, 0)] if len(self.owner) else 0, 0)


def _keys(data: np.ndarray, offs: np.ndarray):
    """(starts, ends, loff, h1, h2, long): lines of each row with the digests of their keys."""
    ls, le, loff = K.lines(data, offs)
    low = K.LOWER[data]
    s, e = K.strip(data, ls, le)
    points = K.code_points(data)
    long = points[e] - points[s] >= MIN_CHARS
    h1 = K.FIRST.ranges(K.FIRST.prefix(low), s, e)
    h2 = K.SECOND.ranges(K.SECOND.prefix(low), s, e)
    return ls, le, loff, h1, h2, long


def _shard_of(h1: np.ndarray, shards: int) -> np.ndarray:
    return ((h1 >> K.U64(40)) % K.U64(shards)).astype(np.int32)


def _reduce(e: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """One entry per key: smallest and largest id, summed rows."""
    order = np.lexsort((e["h2"], e["h1"]))
    e = {k: v[order] for k, v in e.items()}
    new = np.ones(len(order), bool)
    new[1:] = (e["h1"][1:] != e["h1"][:-1]) | (e["h2"][1:] != e["h2"][:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return e
    return {"h1": e["h1"][at], "h2": e["h2"][at], "low": np.minimum.reduceat(e["low"], at),
            "high": np.maximum.reduceat(e["high"], at), "rows": np.add.reduceat(e["rows"], at)}


def _packed(e: dict[str, np.ndarray], fields, shards: int, schema_names) -> pa.RecordBatch:
    shard = _shard_of(e["h1"], shards)
    order = np.argsort(shard, kind="stable")
    ids, first = np.unique(shard[order], return_index=True)
    cols = [pa.array(ids.astype(np.int32))]
    for name, kind in fields:
        v = e[name][order].astype(kind, copy=False)
        cols.append(pa.array([x.tobytes() for x in np.split(v, first[1:])] if len(ids) else [], pa.binary()))
    return pa.RecordBatch.from_arrays(cols, schema_names)


def _block_entries(src: DataFrame, shards: int) -> DataFrame:
    """Packed entries of each block of documents, by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        names = ["shard"] + [f for f, _ in _ENTRY]

        def flush():
            e = _reduce({k: np.concatenate([h[k] for h in held]) for k in held[0]})
            held.clear()
            return _packed(e, _ENTRY, shards, names)

        for batch in batches:
            for rows, data, offs in K.text_chunks(batch):
                _, _, loff, h1, h2, long = _keys(data, offs)
                ids = np.repeat(K.column(rows, "id").to_numpy(), np.diff(loff))[long]
                held.append({"h1": h1[long], "h2": h2[long], "low": ids, "high": ids, "rows": np.ones(len(ids), np.int64)})
                n += len(ids)
                if n >= BLOCK_LINES:
                    yield flush()
                    n = 0
        if held:
            yield flush()

    return src.mapInArrow(run, _ENTRY_SCHEMA)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """The written index: one row of arrays per shard that has repeated keys."""
    src = _source(docs, id_col, text_col)
    shards = shards or _shards(docs)

    def build(key: tuple, table: pa.Table) -> pa.Table:
        e = _reduce({n: np.concatenate([np.frombuffer(x.as_py(), k) for x in table[n]]) for n, k in _ENTRY})
        some = e["low"] != e["high"]
        e = {k: v[some] for k, v in e.items()}
        ph = PerfectHash.build(e["h1"], e["h2"])
        at = ph.find(e["h1"], e["h2"])
        out = {}
        for name, source in (("fingerprint", "h2"), ("count", "rows"), ("owner", "low")):
            a = np.empty(len(at), e[source].dtype)
            a[at] = e[source]
            out[name] = pa.array([a.tobytes()], pa.binary())
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "keys": pa.array([len(at)], pa.int64()),
                         "levels": pa.array([ph.to_rows()], pa.list_(pa.binary())), **out})

    return pin(_block_entries(src, shards).groupBy("shard").applyInArrow(build, _INDEX_SCHEMA).where("keys > 0"))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return ready(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")


def _shards(docs: DataFrame) -> int:
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, estimate_partitions(docs, target_bytes=256 << 20))


def _probe_local(index: DataFrame, shards: int):
    """A function (ids, h1, h2) -> drop mask over a broadcast copy of all arrays."""
    shared = index.sparkSession.sparkContext.broadcast([r.asDict() for r in index.drop("count").collect()])
    loaded: dict[int, Shard] = {}

    def probe(ids, h1, h2):
        if not loaded:
            loaded.update({r["shard"]: Shard(r) for r in shared.value})
        drop = np.zeros(len(h1), bool)
        shard = _shard_of(h1, shards)
        order = np.argsort(shard, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            if len(part) and int(shard[part[0]]) in loaded:
                known, owner = loaded[int(shard[part[0]])].owners(h1[part], h2[part])
                drop[part] = known & (owner != ids[part])
        return drop

    return probe


def _probe_routed(src: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """(id, __drops): per document the first digests of the keys it loses, decided at the keys' shards."""
    fields = [("h1", "<u8"), ("h2", "<u8"), ("id", "<i8")]
    schema = "shard int, " + ", ".join(f"{n} binary" for n, _ in fields)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in K.text_chunks(batch):
                _, _, loff, h1, h2, long = _keys(data, offs)
                ids = np.repeat(K.column(rows, "id").to_numpy(), np.diff(loff))
                yield _packed({"h1": h1[long], "h2": h2[long], "id": ids[long]}, fields, shards, ["shard"] + [f for f, _ in fields])

    def answer(key: tuple, index_rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = [np.zeros((2, 0), np.int64)]
        if index_rows.num_rows and asked.num_rows:
            shard = Shard(index_rows.slice(0, 1).to_pylist()[0])
            for a, b, i in zip(asked["h1"], asked["h2"], asked["id"]):
                h1, h2, ids = np.frombuffer(a.as_py(), "<u8"), np.frombuffer(b.as_py(), "<u8"), np.frombuffer(i.as_py(), "<i8")
                known, owner = shard.owners(h1, h2)
                drop = known & (owner != ids)
                out.append(np.unique(np.stack((ids[drop], h1[drop].view(np.int64))), axis=1))
        ids, h = np.concatenate(out, axis=1)
        return pa.table({"id": ids, "h": h})

    told = index.groupBy("shard").cogroup(src.mapInArrow(ask, schema).groupBy("shard")).applyInArrow(answer, "id long, h long")
    return told.groupBy("id").agg(F.collect_set("h").alias("__drops"))  # a document's own lines


def _probed(docs: DataFrame, id_col: str, text_col: str, broadcast_bytes: int):
    """(frame, probe): the frame to rewrite, and a function (rows, ids, h1, h2, loff) -> drop mask."""
    src = _source(docs, id_col, text_col)
    shards = _shards(docs)
    index = build_index(docs, id_col, text_col, shards)
    size = index.agg(F.sum(F.octet_length("fingerprint") * 3 + F.expr(
        "aggregate(levels, 0L, (a, x) -> a + octet_length(x))"))).first()[0] or 0
    if size <= broadcast_bytes:
        local = _probe_local(index, shards)

        def probe(rows, h1, h2, loff, long):
            ids = K.column(rows, "__id")
            named = np.repeat(np.asarray(ids.is_valid()), np.diff(loff))
            of = np.repeat(ids.fill_null(0).to_numpy(), np.diff(loff))
            drop = np.zeros(len(h1), bool)
            at = np.flatnonzero(long & named)
            drop[at] = local(of[at], h1[at], h2[at])
            return drop

        return docs.withColumn("__id", F.col(id_col).cast("long")), probe

    told = _probe_routed(src, index, shards).withColumnRenamed("id", "__id")

    def probe(rows, h1, h2, loff, long):
        drop = np.zeros(len(h1), bool)
        for i, d in enumerate(K.column(rows, "__drops").to_pylist()):
            if d:
                a, b = loff[i], loff[i + 1]
                drop[a:b] = long[a:b] & np.isin(h1[a:b].view(np.int64), np.asarray(d, np.int64))
        return drop

    return docs.withColumn("__id", F.col(id_col).cast("long")).join(told, "__id", "left"), probe


def _rewritten(rows, data, offs, probe):
    """Per row: (lines, dropped lines, kept bytes)."""
    ls, le, loff, h1, h2, long = _keys(data, offs)
    drop = probe(rows, h1, h2, loff, long)
    count = np.concatenate(([0], np.cumsum(drop)))
    n, dropped = np.diff(loff), count[loff[1:]] - count[loff[:-1]]
    raw = data.tobytes()
    texts = []
    for i in range(len(n)):
        if dropped[i]:
            keep = np.flatnonzero(~drop[loff[i]:loff[i + 1]]) + loff[i]
            texts.append(b"\n".join([raw[ls[k]:le[k]] for k in keep]))
        else:
            texts.append(raw[offs[i]:offs[i + 1]])
    return n, dropped, texts


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document: id, n_lines, n_dropped, kept_sha256."""
    frame, probe = _probed(docs.select(id_col, text_col), id_col, text_col, broadcast_bytes)
    schema = T.StructType([docs.schema[id_col], T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in K.text_chunks(batch, text_col):
                n, dropped, texts = _rewritten(rows, data, offs, probe)
                yield pa.RecordBatch.from_arrays(
                    [K.column(rows, id_col), pa.array(n), pa.array(dropped),
                     pa.array([hashlib.sha256(x).hexdigest() for x in texts])], schema.names)

    return frame.mapInArrow(run, schema)


def dedup_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with repeated lines dropped from the text; all columns, same rows; null texts stay null."""
    frame, probe = _probed(docs, id_col, text_col, broadcast_bytes)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in K.text_chunks(batch, text_col):
                old = K.column(rows, text_col)
                text = old
                _, dropped, texts = _rewritten(rows, data, offs, probe)
                if dropped.any():
                    text = pa.array(texts, pa.binary(), mask=np.asarray(old.is_null())).cast(old.type)
                yield pa.RecordBatch.from_arrays([text if c == text_col else K.column(rows, c) for c in names], names)

    return frame.mapInArrow(run, docs.schema)
