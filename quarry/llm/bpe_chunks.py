"""Byte-level BPE of whole texts with content-defined chunk reuse, and decoding.

A rolling hash over the last ``WINDOW`` bytes cuts every text into chunks of about ``CHUNK`` bytes, at places that
depend on the content alone, so equal passages give equal chunks wherever they stand. A chunk held by at
least two documents is encoded once: its text is reduced to one row per chunk, encoded, and written.

A chunk's own encoding agrees with the text's only from its first to its last word border: there a
non-space character is followed by a white-space one, and no pre-token reaches across. This inner part is what is keyed,
encoded and reused. What lies between two inner parts, the join, is encoded again in its document, from
the last border on the left to the first one on the right; a chunk without two borders is part of a wider join.
Both sides of each join then agree exactly with the encoding of the whole text.

Steps: (1) chunk keys are counted over all documents; (2) the shared ones go into a Bloom filter sized from
their number (at most ``FILTER_BITS``; a false hit sends one chunk through the join for nothing);
(3) texts without shared chunks are encoded where they are read; (4) the others become frames, encoded joins
with holes; holes are filled by an equi-join on the chunk key and put together per text. No text is shuffled
but the shared chunks', once per task that reads them. Equal texts are put together once and joined to their rows.

Defined cases: null texts are empty; empty texts have no ids; rows without an id, repeated rows and very long
texts are encoded like others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkernel as K
from .common import bloom_of, pin, ready
from .tokens import Encoder

CHUNK = 512
WINDOW = 32  # bytes of the rolling hash
_BYTES = np.random.default_rng(0x6EA7).integers(0, 1 << 32, 256, dtype=np.uint32)
RUN_BYTES = 1 << 18  # bytes of text handled at a time
LEAST = 64  # inner parts of fewer bytes are left to the joins
FILTER_BITS = 1 << 28


def cut_places(data: np.ndarray, offs: np.ndarray, average: int = CHUNK) -> np.ndarray:
    """Places where chunks begin, row starts left out: the rolling hash of the ``WINDOW`` bytes before lies below a bound.

    Each byte's hash moves one bit left for every byte after it, so after 32 bytes it has left the 32-bit sum.
    Windows that reach into the row before do not cut.
    """
    h = np.take(_BYTES, data)
    span = 1
    while span < WINDOW:  # h[i] covers the 2 * span bytes up to i
        h[span:] += h[:-span] << np.uint32(span)
        span *= 2
    at = np.flatnonzero(h < np.uint32((1 << 32) // average)) + 1
    row = np.minimum(np.searchsorted(offs, at, "right") - 1, len(offs) - 2)
    return at[(at - offs[row] >= WINDOW) & (at < offs[row + 1])]


def borders(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Places with ASCII white space after a character that is certainly no white space, within a row.

    Characters whose UTF-8 lead byte also begins some white space (C2, E1, E2, E3) do not count.
    """
    at = np.flatnonzero((data == 0x20) | (data == 0x0A) | (data == 0x09) | (data == 0x0D))
    at = at[at > 0]
    last, two, three = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    cont = (last & 0xC0) == 0x80
    plain = (last > 0x20) & (last < 0x7F)
    ok = plain | (cont & (two >= 0xC3) & (two < 0xE0)) | (
        cont & ((two & 0xC0) == 0x80) & ((three == 0xE0) | (three >= 0xE4) & (three < 0xF0)))
    at = at[ok]
    at_row = offs[np.minimum(np.searchsorted(offs, at), len(offs) - 1)]
    return at[at_row != at]


def inner_parts(data: np.ndarray, offs: np.ndarray, average: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the reusable inner parts of the rows' chunks, in order."""
    edges = np.union1d(cut_places(data, offs, average), offs)
    border = borders(data, offs)
    if len(edges) < 2 or not len(border):
        z = np.zeros(0, np.int64)
        return z, z
    i, j = np.searchsorted(border, edges[:-1]), np.searchsorted(border, edges[1:], "right") - 1
    some = j > i
    s, e = border[i[some]], border[j[some]]
    wide = e - s >= LEAST
    return s[wide], e[wide]


def _keys(raw: bytes, s: np.ndarray, e: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """128-bit digests of the parts, and their first halves as integers."""
    keys = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(s.tolist(), e.tolist())]
    return keys, np.frombuffer(b"".join(keys), "<i8")[::2]


def _ids(encoder: Encoder, raw: bytes) -> bytes:
    """Ids of a piece that begins at a word border or at the start of a text.

    The encoder's unit cache needs a word in front of the first space; a border stands after any letter.
    """
    text = raw.decode()
    return encoder.ids("x" + text)[4:] if text[:1].isspace() else encoder.ids(text)


def shared_chunks(src: DataFrame) -> DataFrame:
    """Hashes (``h``) of the inner parts that at least two rows hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offs in K.text_chunks(batch, limit=RUN_BYTES):
                s, e = inner_parts(data, offs)
                _, h = _keys(data.tobytes(), s, e)
                row = np.searchsorted(offs, s, "right")
                order = np.lexsort((row, h))
                h, row = h[order], row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])  # once per row
                key, n = np.unique(h[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int32))], ["h", "n"])

    return (src.mapInArrow(run, "h long, n int").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > 1).select("h"))


def _filter(shared: DataFrame):
    bits = 512
    count = shared.count()
    while bits < 12 * count and bits < FILTER_BITS:
        bits *= 2
    return bloom_of(shared, "h", bits)


def _small(ids: bytes) -> bytes:
    """Little-endian uint32 ids as uint16 where all fit (marked by the first byte)."""
    a = np.frombuffer(ids, "<u4")
    return b"\2" + a.astype("<u2").tobytes() if len(a) == 0 or a.max() < 1 << 16 else b"\4" + ids


def _full(ids: bytes) -> bytes:
    return np.frombuffer(ids, "<u2", offset=1).astype("<u4").tobytes() if ids[:1] == b"\2" else ids[1:]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the ids of every whole text as little-endian unsigned 32-bit integers."""
    src = ready(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")))
    spark = docs.sparkSession
    kept = spark.sparkContext.broadcast(_filter(pin(shared_chunks(src))).bits)  # at most FILTER_BITS / 8 bytes
    kind = docs.schema[id_col].dataType

    def parts(batches: Iterator[pa.RecordBatch]):
        """Per run of rows: (rows, bytes, offs, s, e, keys, poff) of the inner parts that the filter holds."""
        known = K.Bloom(kept.value)
        for batch in batches:
            for rows, data, offs in K.text_chunks(batch, limit=RUN_BYTES):
                s, e = inner_parts(data, offs)
                raw = data.tobytes()
                keys, h = _keys(raw, s, e)
                on = np.flatnonzero(known.has(h))
                s, e = s[on], e[on]
                yield rows, raw, offs, s, e, [keys[i] for i in on], np.searchsorted(s, offs)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for rows, raw, offs, _, _, _, poff in parts(batches):
            on = np.flatnonzero(np.diff(poff) == 0)
            ids = [encoder.ids(raw[offs[i]:offs[i + 1]].decode()) for i in on]
            yield pa.RecordBatch.from_arrays([K.column(rows, "id").take(pa.array(on)), pa.array(ids, pa.binary())], ["id", "ids"])

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for rows, raw, offs, s, e, found, poff in parts(batches):
            on = np.flatnonzero(np.diff(poff) > 0)
            digests, joins, keys = [], [], []
            for i in on:
                a, b = poff[i], poff[i + 1]
                left = [offs[i], *e[a:b]]
                right = [*s[a:b], offs[i + 1]]
                joins.append([_small(_ids(encoder, raw[x:y])) for x, y in zip(left, right)])
                keys.append(found[a:b])
                digests.append(hashlib.sha256(raw[offs[i]:offs[i + 1]]).digest())
            yield pa.RecordBatch.from_arrays(
                [K.column(rows, "id").take(pa.array(on)), pa.array(digests, pa.binary()), pa.array(joins, pa.list_(pa.binary())),
                 pa.array(keys, pa.list_(pa.binary()))], ["id", "digest", "joins", "keys"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw, _, s, e, keys, _ in parts(batches):
            found = {k: raw[a:b] for k, a, b in zip(keys, s, e)}
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.binary())], ["key", "part"])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for b in batches:
            ids = [_small(_ids(encoder, x.as_py())) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], ["key", "ids"])

    once = pin(src.mapInArrow(texts, "key binary, part binary").groupBy("key").agg(F.first("part").alias("part"))
               .mapInArrow(encoded, "key binary, ids binary"))
    out = T.StructType([T.StructField("id", kind), T.StructField("ids", T.BinaryType())])
    framed = pin(src.mapInArrow(frames, T.StructType([
        out.fields[0], T.StructField("digest", T.BinaryType()), T.StructField("joins", T.ArrayType(T.BinaryType())),
        T.StructField("keys", T.ArrayType(T.BinaryType()))])))
    texts_once = framed.groupBy("digest").agg(F.first("joins").alias("joins"), F.first("keys").alias("keys"))  # equal texts, one frame
    asks = texts_once.select("digest", F.posexplode("keys").alias("place", "key"))
    fills = asks.join(once, "key").groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("place", "ids"))).alias("fills"))

    @F.pandas_udf("binary")
    def joined(joins: pd.Series, fills: pd.Series) -> pd.Series:
        done = []
        for j, f in zip(joins, fills):
            row = [_full(j[0])]
            for fill, join in zip(f, j[1:]):
                row += [_full(fill), _full(join)]
            done.append(b"".join(row))
        return pd.Series(done, dtype=object)

    # pinned, so that the join below is of two plain exchanges and Spark can split the rows of a text with many copies
    whole = pin(texts_once.select("digest", "joins").join(fills, "digest").select("digest", joined("joins", F.col("fills.ids")).alias("ids")))
    rows = framed.select("id", "digest").join(whole, "digest").select("id", "ids")
    return src.mapInArrow(alone, out).unionByName(rows).withColumnRenamed("id", id_col)


def piece_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level ``tokenizers`` file, added tokens included."""
    import json

    from .tokens import _byte_alphabet

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = _byte_alphabet()
    added = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
    table = {i: bytes(alphabet[c] for c in p) for p, i in spec["model"]["vocab"].items() if i not in added} | added
    return [table.get(i, b"") for i in range(max(table) + 1)]


def decode(frame: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add the text of ``ids_col`` (bytes as made by ``encode``; null stays null); bytes that are no UTF-8 become U+FFFD."""
    schema = T.StructType([*frame.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = piece_bytes(path).__getitem__
        for b in batches:
            for rows in (b.slice(i, 200) for i in range(0, b.num_rows, 200)):
                text = [None if x is None else b"".join(map(piece, np.frombuffer(x, "<u4").tolist())).decode("utf-8", "replace")
                        for x in K.column(rows, ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(text, pa.string())], schema.names)

    return ready(frame).mapInArrow(run, schema)
