"""Substring deduplication by hashing units of text.

A unit is a sentence: it ends at a line feed, or after ``.``, ``!`` or ``?`` before white space. Its
digest is 128 bits over its words, A-Z lower-cased, so white space does not count. Digests are grouped
over the whole corpus and the occurrence with the smallest (id, text, place) is the first one. A run of
neighbouring units, each with an earlier occurrence elsewhere, is removed when it has ``MIN_RUN_WORDS``
words or more; shorter repeats (stock phrases) stay. First occurrences are never in a run, so
every removed unit still stands somewhere. Removed ranges are returned as character offsets.

With ``inside=True`` (the registered query and the pipeline) passages that begin or end inside a unit go as
well. An anchor is a run of ``GRAM_WORDS`` words whose hash is the least of ``WINDOW`` neighbouring runs, so
two places that share ``MIN_RUN_WORDS`` words share an anchor there. Each anchor is extended word by word, up
to ``WINDOW`` words to each side, against the first occurrence of its run, and the range is removed when it
has ``MIN_RUN_WORDS`` words or more. Ranges that touch are one. An earlier occurrence in the same text counts
only where the two do not overlap. A passage is found against the first occurrence of each of its anchors
only: where that first occurrence continues differently, words near it can stay.

Scale: units travel as (key, place, digest), never as text; the first place of a digest is a partially
aggregated minimum, and the join that marks repeats reads only units that pass a Bloom filter of fixed
size (a false hit is dropped by the join). A passage in a third of all documents is a skewed key of
that join, which adaptive execution splits.

Defined cases: null and empty texts have no units; rows without an id are returned unchanged and own
nothing; repeated rows (same id and text) are one document and treated alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkernel as K
from .common import bloom_of, pin, ready

MIN_RUN_WORDS, EDGE_WORDS, BLOOM_BITS = 30, 3, 1 << 25
GRAM_WORDS = 16
WINDOW = MIN_RUN_WORDS - GRAM_WORDS + 1  # below GRAM_WORDS, so the anchors of one passage touch
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True


def units(data: np.ndarray, offs: np.ndarray):
    """(starts, ends, words, h1, h2, uoff): the units of each row, trimmed, with their digests."""
    low = K.LOWER[data]
    s, e, woff = K.words(low, offs)
    if len(s) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64), z.view(np.uint64), np.zeros(len(offs), np.int64)
    feeds = np.searchsorted(np.flatnonzero(data == 10), s)
    begins = np.ones(len(s), bool)
    begins[1:] = _STOP[data[e[:-1] - 1]] | (feeds[1:] != feeds[:-1])
    begins[woff[:-1][woff[:-1] < len(s)]] = True
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(s))
    h = []
    for rh in (K.FIRST, K.SECOND):
        wh = rh.ranges(rh.prefix(low), s, e)
        rh._grow(len(wh) + 1)
        c = np.concatenate((np.zeros(1, np.uint64), np.cumsum(wh * rh.power[:len(wh)])))
        h.append(K.mix((c[last] - c[first]) * rh.back[first] + (last - first).astype(np.uint64)))
    return s[first], e[last - 1], last - first, h[0], h[1], np.searchsorted(first, woff)


def _unit_rows(docs: DataFrame, only: "object | None" = None) -> DataFrame:
    """(id, tkey, place, h1, h2) of every unit; with ``only``, of units whose digest may be in that filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = K.Bloom(only.value) if only is not None else None
        for batch in batches:
            for rows, data, offs in K.text_chunks(batch):
                _, _, _, h1, h2, uoff = units(data, offs)
                per = np.diff(uoff)
                row = np.repeat(np.arange(len(per)), per)
                place = np.arange(len(row)) - uoff[:-1][row]
                cols = [K.column(rows, "id").to_numpy()[row], K.column(rows, "tkey").to_numpy()[row], place,
                        h1.view(np.int64), h2.view(np.int64)]
                if bloom is not None:
                    hit = bloom.has(cols[3])
                    cols = [c[hit] for c in cols]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["id", "tkey", "place", "h1", "h2"])

    return docs.mapInArrow(run, "id long, tkey long, place long, h1 long, h2 long")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tkey, places): per document the sorted places of units that occur earlier elsewhere."""
    src = ready(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                             F.xxhash64(F.col(text_col).cast("string")).alias("tkey")).where("id is not null")
    rank = F.struct("id", "tkey", "place")
    firsts = (_unit_rows(src).groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
              .where("first != last").select("h1", "h2", "first"))
    firsts = pin(firsts)
    bits = docs.sparkSession.sparkContext.broadcast(bloom_of(firsts, "h1", BLOOM_BITS).bits)  # BLOOM_BITS / 8 bytes
    again = _unit_rows(src, bits).join(firsts, ["h1", "h2"]).where(rank != F.col("first"))
    return again.groupBy("id", "tkey").agg(F.sort_array(F.collect_set("place")).alias("places"))


def _slide(x: np.ndarray, n: int, f) -> np.ndarray:
    """``f`` over each ``n`` neighbours."""
    size = 1
    while size * 2 <= n:
        x = f(x[:-size], x[size:])
        size *= 2
    return f(x[:len(x) - (n - size)], x[n - size:]) if size < n else x


def _hashed_words(data: np.ndarray, offs: np.ndarray):
    """(starts, ends, woff, hashes) of the words of each row, A-Z lower-cased."""
    low = K.LOWER[data]
    s, e, woff = K.words(low, offs)
    return s, e, woff, K.FIRST.ranges(K.FIRST.prefix(low), s, e)


def anchors(wh: np.ndarray, woff: np.ndarray):
    """(row, at, hash): the anchors of each row, at the word where their run begins."""
    if len(wh) < MIN_RUN_WORDS:
        z = np.zeros(0, np.int64)
        return z, z, z.view(np.uint64)
    row = np.repeat(np.arange(len(woff) - 1), np.diff(woff))
    g = K.combine(wh, GRAM_WORDS, np.arange(len(wh) - GRAM_WORDS + 1))
    least = _slide(g, WINDOW, np.minimum)
    least[row[:len(least)] != row[MIN_RUN_WORDS - 1:]] = 0  # windows that cross a row border choose nothing
    top = _slide(np.pad(least, WINDOW - 1), WINDOW, np.maximum)
    at = np.flatnonzero((top == g) & (g > 0))
    return row[at], at, g[at]


def _around(wh: np.ndarray, woff: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """32-bit hashes of the ``WINDOW`` words before (nearest first) and behind each anchor; 0 outside its row."""
    if len(at) == 0:
        return np.zeros((0, 2 * WINDOW), "<u4")
    short = (wh >> K.U64(32)).astype("<u4") | np.uint32(1)
    k = np.arange(1, WINDOW + 1)
    left, right = at[:, None] - k, at[:, None] + GRAM_WORDS - 1 + k
    return np.concatenate((np.where(left >= woff[row][:, None], short[np.maximum(left, 0)], 0),
                           np.where(right < woff[row + 1][:, None], short[np.minimum(right, len(wh) - 1)], 0)), axis=1).astype("<u4")


def _anchor_rows(docs: DataFrame, only: "object | None" = None) -> DataFrame:
    """(id, tkey, place, h) of every anchor; with ``only``, of anchors that may be in that filter, with ``near`` of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = K.Bloom(only.value) if only is not None else None
        for batch in batches:
            for rows, data, offs in K.text_chunks(batch):
                _, _, woff, wh = _hashed_words(data, offs)
                row, at, h = anchors(wh, woff)
                h = h.view(np.int64)
                if bloom is not None:
                    hit = bloom.has(h)
                    row, at, h = row[hit], at[hit], h[hit]
                cols = [pa.array(c) for c in (K.column(rows, "id").to_numpy()[row], K.column(rows, "tkey").to_numpy()[row], at - woff[row], h)]
                if bloom is not None:
                    cols.append(pa.array([x.tobytes() for x in _around(wh, woff, row, at)], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, ["id", "tkey", "place", "h", "near"][:len(cols)])

    return docs.mapInArrow(run, "id long, tkey long, place long, h long" + ("" if only is None else ", near binary"))


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tkey, anchors): per document the anchors that occur earlier elsewhere, as (place, back, near).

    ``back`` is the way back to a first occurrence in the same text (0: another text), ``near`` the words around it.
    """
    src = ready(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                             F.xxhash64(F.col(text_col).cast("string")).alias("tkey")).where("id is not null")
    rank = F.struct("id", "tkey", "place")
    firsts = (_anchor_rows(src).groupBy("h").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
              .where("first != last").select("h", "first"))
    firsts = pin(firsts)
    bits = docs.sparkSession.sparkContext.broadcast(bloom_of(firsts, "h", BLOOM_BITS).bits)  # BLOOM_BITS / 8 bytes
    own = rank == F.col("first")
    hits = pin(_anchor_rows(src, bits).join(firsts, "h").select("h", "id", "tkey", "place", "first", F.when(own, F.col("near")).alias("near")))
    owners = hits.where(own).select("h", "near").dropDuplicates(["h"])
    same = (F.col("id") == F.col("first.id")) & (F.col("tkey") == F.col("first.tkey"))
    back = F.when(same, F.col("place") - F.col("first.place")).otherwise(F.lit(0))
    again = hits.where(~own).select("h", "id", "tkey", "place", back.alias("back")).join(owners, "h")
    return again.groupBy("id", "tkey").agg(F.sort_array(F.collect_set(F.struct("place", "back", "near"))).alias("anchors"))


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words with those that touch made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _with_passages(data, offs, cuts, found) -> list[list[tuple[int, int]]]:
    """``cuts`` and the extended anchors of each row, as byte ranges."""
    if not any(found):
        return cuts
    s, e, woff, wh = _hashed_words(data, offs)
    out = []
    for i, (cut, own) in enumerate(zip(cuts, found)):
        if own:
            at = woff[i] + np.array([x["place"] for x in own])
            back = np.array([x["back"] for x in own])
            theirs = np.frombuffer(b"".join(x["near"] for x in own), "<u4").reshape(-1, 2, WINDOW)
            mine = _around(wh, woff, np.full(len(at), i), at).reshape(-1, 2, WINDOW)
            left, right = np.cumprod((mine == theirs) & (mine > 0), axis=2).sum(axis=2).T
            room = np.where(back > 0, np.maximum(back - GRAM_WORDS, 0), 2 * WINDOW)  # the two must not overlap
            left = np.minimum(left, room)
            right = np.minimum(right, room - left)
            ok = (left + right + GRAM_WORDS >= MIN_RUN_WORDS) & ((back == 0) | (back >= MIN_RUN_WORDS))
            spans = list(zip((at - left)[ok].tolist(), (at + GRAM_WORDS + right)[ok].tolist()))
            spans += [(int(np.searchsorted(s, a)), int(np.searchsorted(e, b)) + 1) for a, b in cut]
            cut = [(int(s[a]), int(e[b - 1])) for a, b in _joined(spans)]
        out.append(cut)
    return out


def _cuts(data, offs, places, found) -> list[list[tuple[int, int]]]:
    """Byte ranges to remove from each row."""
    s, e, n, _, _, uoff = units(data, offs)
    out = []
    for i, p in enumerate(places):
        cut = []
        if p is not None and len(p):
            p = np.asarray(p)
            for run in np.split(p, np.flatnonzero(np.diff(p) != 1) + 1):
                at = uoff[i] + run
                long = np.flatnonzero(n[at] >= EDGE_WORDS)  # a run neither begins nor ends with a tiny unit
                if len(long):
                    at = at[long[0]:long[-1] + 1]
                    if n[at].sum() >= MIN_RUN_WORDS:
                        cut.append((int(s[at[0]]), int(e[at[-1]])))
        out.append(cut)
    return _with_passages(data, offs, out, found)


def _without(data: np.ndarray, a: int, b: int, cuts) -> bytes:
    """The row without the ranges, and without the white space that a range leaves at its right (or line it empties)."""
    raw = data[a:b].tobytes()
    parts, at = [], 0
    for s, e in cuts:
        s, e = s - a, e - a
        left = raw[at:s]
        while e < len(raw) and raw[e] in b" \t\r":
            e += 1
        if e < len(raw) and raw[e] == 10 and (not left or left.endswith(b"\n")):
            e += 1
        parts.append(left)
        at = e
    parts.append(raw[at:])
    return b"".join(parts)


def _marked(docs: DataFrame, id_col: str, text_col: str, inside: bool) -> DataFrame:
    """The documents with ``__places`` of their repeated units and ``__anchors`` of their repeated passages."""
    found = repeats(docs, id_col, text_col)
    if inside:
        found = found.join(passages(docs, id_col, text_col), ["id", "tkey"], "full")
    else:
        found = found.withColumn("anchors", F.lit(None).cast("array<struct<place:bigint,back:bigint,near:binary>>"))
    found = found.select(F.col("id").alias("__id"), F.col("tkey").alias("__tkey"), F.col("places").alias("__places"),
                         F.col("anchors").alias("__anchors"))
    keyed = docs.withColumns({"__id": F.col(id_col).cast("long"), "__tkey": F.xxhash64(F.col(text_col).cast("string"))})
    return keyed.join(found, ["__id", "__tkey"], "left").select(*docs.columns, "__places", "__anchors")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", inside: bool = False) -> DataFrame:
    """Per document: id, n_units, n_removed (ranges), removed (start, end in code points), n_chars and kept_sha256 of what stays."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)]
                          + [T.StructField(c, T.LongType()) for c in ("n_units", "n_removed")]
                          + [T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                                               T.StructField("end", T.LongType())]))),
                             T.StructField("n_chars", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in K.text_chunks(batch, text_col):
                uoff = units(data, offs)[5]
                cuts = _cuts(data, offs, K.column(rows, "__places").to_pylist(), K.column(rows, "__anchors").to_pylist())
                points = K.code_points(data)
                texts = [_without(data, a, b, c) for a, b, c in zip(offs[:-1], offs[1:], cuts)]
                spans = [[{"start": int(points[s] - points[a]), "end": int(points[e] - points[a])} for s, e in c]
                         for a, c in zip(offs[:-1], cuts)]
                yield pa.RecordBatch.from_arrays(
                    [K.column(rows, id_col), pa.array(np.diff(uoff)), pa.array([len(c) for c in cuts], pa.int64()),
                     pa.array(spans, span), pa.array([len(x.decode()) for x in texts], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in texts])], schema.names)

    return _marked(docs.select(id_col, text_col), id_col, text_col, inside).mapInArrow(run, schema)


def dedup_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", inside: bool = False) -> DataFrame:
    """``docs`` with repeated passages removed from the text; all columns, same rows; null texts stay null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in K.text_chunks(batch, text_col):
                cuts = _cuts(data, offs, K.column(rows, "__places").to_pylist(), K.column(rows, "__anchors").to_pylist())
                old = K.column(rows, text_col)
                text = pa.array([_without(data, offs[i], offs[i + 1], c).decode() if c else old[i].as_py()
                                 for i, c in enumerate(cuts)], old.type)
                yield pa.RecordBatch.from_arrays([text if c == text_col else K.column(rows, c) for c in names], names)

    names = docs.columns
    return _marked(docs, id_col, text_col, inside).mapInArrow(run, docs.schema)
