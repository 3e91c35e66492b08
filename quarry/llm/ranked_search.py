"""Ranked lexical search: Block-Max MaxScore over index segments that Spark builds and searches in parallel.

``build_index`` cuts the documents into segments (at most ``SEGMENT_DOCS`` documents or about
``SEGMENT_BYTES`` of text; a longer text is a segment of its own) inside the scan's tasks: nothing is
shuffled. A segment is one row: sorted term hashes, posting lists as variable-length integers in blocks of
``BLOCK`` postings, and per block its first and last document and its competitive (tf, length) pairs, the
postings that no other one of the block beats in both. Those pairs give exact block maxima once the
corpus statistics N and L are known, so the index does not depend on them and segments can be added. The arrays of
a segment lie compressed in its row, and the index is written in small row groups: Spark decodes a whole one at a time.

``search`` sums N, L and the queries' document frequencies over the index and scores each query per segment:
list bounds split the lists into essential ones, whose documents are candidates, and the rest; on the rest,
from the largest bound down, a candidate whose score plus block maximum plus remaining bounds stays below the
query's threshold is rejected before any posting of that block is decompressed. The threshold, the k-th best
score so far, is carried over the segments of a task; the tasks' heaps (k rows a query) are merged by rank.

Scores are 64-bit integers: sum over the query's distinct terms of ``w * ((1000000000 * tf) div (1000 * tf + 20 * m))``
with ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and ``m = 50 + ((50 * n * N) div L)``.

Terms are 64-bit hashes of their bytes (A-Z lower-cased). Queries are read in blocks of at most ``QUERY_ROWS``
rows, so no table passes whole through the driver.

Defined cases: null and empty texts have no terms and are never found; query rows with one id are one query with
the terms of all of them; a query without terms has no rows; repeated documents are ranked one by one; a document without an id
comes last among equal scores; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkernel as K
from .common import pin, ready

SEGMENT_DOCS = 4096
SEGMENT_BYTES = 4 << 20
BLOCK = 64
QUERY_ROWS = 2000
# Constants of the ranking function.
K1_SCALE, SCALE, LENGTH_SCALE, LENGTH_SHARE = 1000, 1_000_000_000, 20, 50

TERM = np.zeros(256, bool)
TERM[0x30:0x3A] = TERM[0x41:0x5B] = TERM[0x61:0x7B] = TERM[0x80:] = True

_COLUMNS = {"ids": "<i8", "named": "u1", "lens": "<i8", "terms": "<u8", "lists": "<i8", "dfs": "<i8", "first": "<i4", "last": "<i4",
            "bytes_at": "<i8", "pairs_at": "<i8", "pair_tf": "<i8", "pair_n": "<i8", "postings": "u1"}
INDEX_SCHEMA = "with_terms long, length long, " + ", ".join(f"{c} binary" for c in _COLUMNS)
# Row groups of about so many bytes, looked at after every row, as Parquet's writer would first look after 100 rows.
_WRITTEN = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}


def hashed_terms(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, toff): the terms of every row in order, A-Z lower-cased."""
    low = K.LOWER[data]
    s, e = K._edges(low, offs, TERM[low])
    return K.FIRST.ranges(K.FIRST.prefix(low), s, e), np.searchsorted(s, offs)


def _varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): 7 bits a byte, low bits first, the high bit marks a further byte."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        size += values >= (K.U64(1) << K.U64(bits))
    at = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(at[-1], np.uint8)
    for k in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > k)
        part = (values[on] >> K.U64(7 * k)).astype(np.uint8) & 0x7F
        out[at[on] + k] = part | np.where(size[on] > k + 1, 0x80, 0).astype(np.uint8)
    return out, at


def _from_varints(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw < 0x80)
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(ends) == len(raw):
        return raw.astype(np.int64)
    shift = 7 * (np.arange(len(raw)) - np.repeat(starts, ends - starts + 1))
    return np.add.reduceat((raw & 0x7F).astype(np.int64) << shift, starts)


def build_segment(ids: list, hashes: np.ndarray, lens: np.ndarray) -> dict:
    """One index row from documents (ids, None allowed), their term hashes in document order and term counts."""
    docs = np.repeat(np.arange(len(lens), dtype=np.int64), lens)
    order = np.argsort(hashes, kind="stable")  # documents ascend within a term
    h, d = hashes[order], docs[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(h)))
    h, d = h[at], d[at]
    head = np.ones(len(h), bool)
    head[1:] = h[1:] != h[:-1]
    list_at = np.flatnonzero(head)
    df = np.diff(np.append(list_at, len(h)))
    of_list = np.repeat(np.arange(len(list_at)), df)
    begins = head | ((np.arange(len(h)) - list_at[of_list]) % BLOCK == 0)
    block_at = np.flatnonzero(begins)
    block = np.cumsum(begins) - 1
    blocks = np.bincount(of_list[block_at], minlength=len(list_at)) if len(h) else np.zeros(0, np.int64)
    ends = np.append(block_at[1:], len(h)) if len(h) else np.zeros(0, np.int64)
    gap = d.copy()
    gap[1:] -= d[:-1]
    gap[block_at] = 0  # the block's first document is stored beside it
    raw, val_at = _varints(np.stack([gap, tf], 1).ravel())
    # competitive pairs: in order of falling tf, those with a smaller length than all before
    n = lens[d]
    rank = np.lexsort((n, -tf, block))
    low = n[rank] - block[rank] * (1 << 40)  # a new block starts below all earlier ones
    least = np.minimum.accumulate(low) if len(low) else low
    best = np.ones(len(low), bool)
    best[1:] = low[1:] < least[:-1]
    pairs = rank[best]
    arrays = {
        "ids": np.array([0 if i is None else i for i in ids], np.int64), "named": np.array([i is not None for i in ids], np.uint8),
        "lens": lens, "terms": h[list_at], "lists": np.concatenate(([0], np.cumsum(blocks))), "dfs": df,
        "first": d[block_at], "last": d[ends - 1], "bytes_at": val_at[2 * np.append(block_at, len(h))],
        "pairs_at": np.concatenate(([0], np.cumsum(np.bincount(block[pairs], minlength=len(block_at))))) if len(h) else [0],
        "pair_tf": tf[pairs], "pair_n": n[pairs], "postings": raw,
    }
    row = {c: np.asarray(arrays[c]).astype(t).tobytes() for c, t in _COLUMNS.items()}
    return {"with_terms": int((lens > 0).sum()), "length": int(lens.sum()), **row}


def _packed(raw: bytes) -> bytes:
    """Compressed, after its length."""
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpacked(packed) -> pa.Buffer:
    packed = memoryview(packed)
    return pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"))


def _unpacked_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The index rows, one at a time, with their arrays as ``build_segment`` gives them."""
    for b in batches:
        for i in range(b.num_rows):
            yield {n: _unpacked(c[i].as_buffer()) if n in _COLUMNS else c[i].as_py() for n, c in zip(b.schema.names, b.columns)}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The segments of all documents, one row each, arrays compressed; write it (``pin_index``) before searching it more than once."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    names = T._parse_datatype_string(INDEX_SCHEMA).names

    def out(ids, hashes, lens):
        row = build_segment(ids, np.concatenate(hashes), np.concatenate(lens))
        return pa.RecordBatch.from_pylist([{c: _packed(row[c]) if c in _COLUMNS else row[c] for c in names}])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, lens, size = [], [], [], 0
        for batch in batches:
            for rows, data, offs in K.text_chunks(batch):
                if ids and (len(ids) + rows.num_rows > SEGMENT_DOCS or size + len(data) > SEGMENT_BYTES):
                    yield out(ids, hashes, lens)
                    ids, hashes, lens, size = [], [], [], 0
                h, toff = hashed_terms(data, offs)
                ids += K.column(rows, "id").to_pylist()
                hashes.append(h)
                lens.append(np.diff(toff))
                size += len(data)
        if ids:
            yield out(ids, hashes, lens)

    return ready(src).mapInArrow(run, INDEX_SCHEMA)


def pin_index(index: DataFrame) -> DataFrame:
    return pin(index, _WRITTEN)


class Segment:
    """Arrays of one index row with the bounds of the wanted terms for given corpus statistics."""

    def __init__(self, row: dict, wanted: np.ndarray, weights: np.ndarray, n_docs: int, total: int):
        for c, t in _COLUMNS.items():
            setattr(self, c, np.frombuffer(row[c], t))
        at = np.searchsorted(self.terms, wanted)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == wanted[known]
        self.at = np.where(known, at, -1)
        self.weights, self.m = weights, 50 + (LENGTH_SHARE * self.lens * n_docs) // max(total, 1)
        m = 50 + (LENGTH_SHARE * self.pair_n * n_docs) // max(total, 1)
        part = (SCALE * self.pair_tf) // (K1_SCALE * self.pair_tf + LENGTH_SCALE * m)
        self.block_max = np.maximum.reduceat(part, self.pairs_at[:-1]) if len(part) else part
        list_max = np.maximum.reduceat(self.block_max, self.lists[:-1]) if len(part) else part
        self.bound = np.zeros(len(wanted), np.int64)
        self.bound[known] = weights[known] * list_max[at[known]]
        self.whole: dict = {}
        self.blocks_read = 0

    def read(self, term: int, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of some blocks of a wanted term's list."""
        docs, tfs = [], []
        for b in blocks:
            pair = _from_varints(self.postings[self.bytes_at[b]:self.bytes_at[b + 1]])
            docs.append(np.cumsum(pair[0::2]) + self.first[b])
            tfs.append(pair[1::2])
        self.blocks_read += len(blocks)
        d, tf = np.concatenate(docs), np.concatenate(tfs)
        return d, self.weights[term] * ((SCALE * tf) // (K1_SCALE * tf + LENGTH_SCALE * self.m[d]))

    def read_list(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        if term not in self.whole:
            lo, hi = self.lists[self.at[term]], self.lists[self.at[term] + 1]
            pair = _from_varints(self.postings[self.bytes_at[lo]:self.bytes_at[hi]])
            d, tf = np.cumsum(pair[0::2]), pair[1::2]
            heads = np.arange(0, len(d), BLOCK)
            d += np.repeat(self.first[lo:hi] - d[heads], np.diff(np.append(heads, len(d))))
            self.blocks_read += hi - lo
            self.whole[term] = d, self.weights[term] * ((SCALE * tf) // (K1_SCALE * tf + LENGTH_SCALE * self.m[d]))
        return self.whole[term]

    def candidates(self, terms: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) with a score of at least ``need`` (``need`` is 1 or more)."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        terms = terms[self.bound[terms] > 0]
        terms = terms[np.argsort(self.bound[terms], kind="stable")]
        below = np.concatenate(([0], np.cumsum(self.bound[terms])))  # below[i]: all lists before i together
        if below[-1] < need:
            return none
        essential = int(np.searchsorted(below, need)) - 1  # lists before it cannot reach the threshold together
        score = np.zeros(len(self.lens), np.int64)
        for t in terms[essential:]:
            d, s = self.read_list(t)
            score[d] += s
        found = np.flatnonzero(score)
        for i in range(essential - 1, -1, -1):
            found = found[score[found] + below[i + 1] >= need]
            if not len(found):
                return none
            t = terms[i]
            if t in self.whole:
                d, s = self.whole[t]
                score[d] += s
                continue
            lo, hi = self.lists[self.at[t]], self.lists[self.at[t] + 1]
            b = np.searchsorted(self.last[lo:hi], found)
            inside = b < hi - lo
            inside[inside] = self.first[lo + b[inside]] <= found[inside]
            most = np.zeros(len(found), np.int64)
            most[inside] = self.weights[t] * self.block_max[lo + b[inside]]
            keep = score[found] + most + below[i] >= need  # rejected before decompression
            blocks = np.unique(b[keep & inside]) + lo
            found = found[keep]
            if len(blocks) * 2 > hi - lo:
                d, s = self.read_list(t)
                score[d] += s
            elif len(blocks):
                d, s = self.read(t, blocks)
                score[d] += s
        found = found[score[found] >= need]
        return found, score[found]


class Heap:
    """The k best (score, id) of a query; a missing id comes last among equal scores."""

    def __init__(self, k: int):
        self.k = k
        self.score = self.ids = np.zeros(0, np.int64)
        self.unnamed = np.zeros(0, bool)

    @property
    def need(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        score, ids, unnamed = (np.concatenate(x) for x in ((self.score, score), (self.ids, ids), (self.unnamed, unnamed)))
        best = np.lexsort((ids, unnamed, -score))[:self.k]
        self.score, self.ids, self.unnamed = score[best], ids[best], unnamed[best]


def search_rows(rows: Iterator[dict], queries: list[np.ndarray], wanted: np.ndarray, weights: np.ndarray, n_docs: int,
                total: int, k: int) -> tuple[list[Heap], int, int]:
    """Heaps of the queries (arrays of positions in ``wanted``) over index rows; blocks read and blocks there were."""
    heaps = [Heap(k) for _ in queries]
    read = there = 0
    for row in rows:
        seg = Segment(row, wanted, weights, n_docs, total)
        for terms, heap in zip(queries, heaps):
            d, s = seg.candidates(terms, heap.need)
            if len(d):
                heap.add(s, seg.ids[d], seg.named[d] == 0)
        on = seg.at[seg.at >= 0]
        read, there = read + seg.blocks_read, there + int((seg.lists[on + 1] - seg.lists[on]).sum())
    return heaps, read, there


def _query_blocks(queries: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(item ids, term hashes) in blocks of bounded length; rows of one id are one query."""
    items = (queries.select(F.col(item_col).alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
             .groupBy("item").agg(F.array_join(F.sort_array(F.collect_set("text")), "\n").alias("text")).orderBy("item"))
    ids, terms = [], []
    for r in items.toLocalIterator():
        raw = np.frombuffer(r["text"].encode(), np.uint8)
        ids.append(r["item"])
        terms.append(np.unique(hashed_terms(raw, np.array([0, len(raw)]))[0]))
        if len(ids) == QUERY_ROWS:
            yield ids, terms
            ids, terms = [], []
    if ids:
        yield ids, terms


def _frequencies(index: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """Document frequency of each wanted term: partial counts per task, summed by Spark."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(wanted), np.int64)
        for b in batches:
            for terms, counts in zip(b.column(0), b.column(1)):
                terms, counts = np.frombuffer(_unpacked(terms.as_buffer()), "<u8"), np.frombuffer(_unpacked(counts.as_buffer()), "<i8")
                at = np.searchsorted(terms, wanted)
                on = at < len(terms)
                on[on] = terms[at[on]] == wanted[on]
                df[on] += counts[at[on]]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(df[some])], ["term", "df"])

    out = np.zeros(len(wanted), np.int64)
    for r in index.select("terms", "dfs").mapInArrow(part, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]  # at most one row per wanted term
    return out


def search(index: DataFrame, queries: DataFrame, k: int = 50, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The k best documents of each query: ``item_col``, rank, doc_id, score."""
    spark = index.sparkSession
    kind = queries.schema[item_col].dataType
    schema = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    stats = index.agg(F.sum("with_terms").alias("n"), F.sum("length").alias("l")).first()
    n_docs, total = int(stats["n"] or 0), int(stats["l"] or 0)
    result = spark.createDataFrame([], T.StructType([T.StructField(item_col, kind), *schema.fields[1:]]))
    for ids, terms in _query_blocks(queries, item_col, text_col):
        wanted = np.unique(np.concatenate(terms))
        df = _frequencies(index, wanted)
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        places = [np.searchsorted(wanted, t) for t in terms]

        def run(batches: Iterator[pa.RecordBatch], places=places, wanted=wanted, weights=weights) -> Iterator[pa.RecordBatch]:
            heaps, _, _ = search_rows(_unpacked_rows(batches), places, wanted, weights, n_docs, total, k)
            for i, h in enumerate(heaps):
                if len(h.score):
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(h.score), pa.int32()), pa.array(h.ids, mask=h.unnamed),
                                                      pa.array(h.score)], schema.names)

        names = spark.createDataFrame(list(enumerate(ids)), T.StructType([schema.fields[0], T.StructField(item_col, kind)]))
        heads = index.mapInArrow(run, schema)
        best = heads.withColumn("rank", F.row_number().over(
            Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= k)
        part = best.join(F.broadcast(names), "place").select(item_col, "rank", "doc_id", "score")  # at most QUERY_ROWS names
        result = part if "rank" not in result.columns else result.unionByName(part)
    if "rank" not in result.columns:
        result = result.select(item_col, F.lit(1).alias("rank"), "doc_id", "score")
    return result


def search_documents(docs: DataFrame, queries: DataFrame, k: int = 50) -> DataFrame:
    """Index all documents (pinned once) and rank them for each query."""
    return search(pin_index(build_index(docs)), queries, k)
