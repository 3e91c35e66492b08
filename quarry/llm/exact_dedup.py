"""Exact deduplication by a sharded cuckoo-filter index over live text digests.

Texts are equal when equal after each run of ASCII white space becomes one space; the key is their
SHA-256. An index bucket (by the digest's first bytes) holds a cuckoo filter and the stored keys with
the smallest id and the number of rows. A digest the filter rules out is new; a filter hit is verified
against the stored keys of the bucket. When an insertion finds no free slot, the filter doubles and is
rebuilt from the stored keys. Deleting a digest removes its fingerprint and its key.

Rows are grouped by (digest, salt) before they go to their bucket, so a digest held by a third of all
rows reaches one bucket as at most ``SALTS`` rows; buckets are as many as the rows need (``bucket_count``).

Defined cases: null text equals the empty text; of equal texts the smallest id stays, a null id only
when no row of the group has an id; of rows with the smallest id all are marked kept only if they are
repeated rows of that same id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready

SALTS, SLOTS, MAX_KICKS, LOAD = 32, 4, 64, 0.85
BUCKET_KEYS = 50_000  # an index row of some 2 MB
INDEX_SCHEMA = "bucket int, filter binary, digest array<binary>, id array<long>, rows array<long>"


class Full(Exception):
    """No free slot after the allowed number of moves."""


class CuckooFilter:
    """16-bit fingerprints in two candidate buckets of four slots; 0 marks a free slot."""

    def __init__(self, buckets: int, table: list[int] | None = None):
        self.mask = buckets - 1
        self.table = table if table is not None else [0] * (buckets * SLOTS)

    @classmethod
    def sized_for(cls, keys: int) -> "CuckooFilter":
        n = 4
        while n * SLOTS * LOAD < keys:
            n *= 2
        return cls(n)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        fp = int.from_bytes(digest[8:10], "little") or 1
        a = int.from_bytes(digest[16:24], "little") & self.mask
        return fp, a, self._other(a, fp)

    def _other(self, at: int, fp: int) -> int:
        return (at ^ (fp * 0x5BD1E995)) & self.mask

    def _slots(self, at: int) -> range:
        return range(at * SLOTS, at * SLOTS + SLOTS)

    def __contains__(self, digest: bytes) -> bool:
        fp, a, b = self._places(digest)
        t = self.table
        return fp in t[a * SLOTS:a * SLOTS + SLOTS] or fp in t[b * SLOTS:b * SLOTS + SLOTS]

    def insert(self, digest: bytes) -> None:
        fp, a, b = self._places(digest)
        for at in (a, b):
            for s in self._slots(at):
                if not self.table[s]:
                    self.table[s] = fp
                    return
        at, moved = b, []
        for kick in range(MAX_KICKS):
            s = at * SLOTS + (fp + kick) % SLOTS
            moved.append((s, self.table[s]))
            fp, self.table[s] = self.table[s], fp
            at = self._other(at, fp)
            for s in self._slots(at):
                if not self.table[s]:
                    self.table[s] = fp
                    return
        for s, old in reversed(moved):  # leave the table as it was
            self.table[s] = old
        raise Full

    def delete(self, digest: bytes) -> bool:
        fp, a, b = self._places(digest)
        for at in (a, b):
            for s in self._slots(at):
                if self.table[s] == fp:
                    self.table[s] = 0
                    return True
        return False

    def to_bytes(self) -> bytes:
        return np.asarray(self.table, "<u2").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> "CuckooFilter":
        table = np.frombuffer(raw, "<u2").tolist()
        return cls(len(table) // SLOTS, table)


class Bucket:
    """One index bucket: the filter answers first, the stored keys decide."""

    def __init__(self, filter_: CuckooFilter | None = None, keys: dict[bytes, list] | None = None):
        self.filter = filter_ or CuckooFilter.sized_for(1)
        self.keys = keys or {}
        self.resizes = 0

    def find(self, digest: bytes) -> list | None:
        return self.keys.get(digest) if digest in self.filter else None

    def insert(self, digest: bytes, id_: int | None, rows: int = 1) -> None:
        held = self.find(digest)
        if held is not None:
            held[1] += rows
            if id_ is not None and (held[0] is None or id_ < held[0]):
                held[0] = id_
            return
        self.keys[digest] = [id_, rows]
        try:
            self.filter.insert(digest)
        except Full:
            self._resize()

    def _resize(self) -> None:
        size = 2 * (self.filter.mask + 1)
        while True:
            self.resizes += 1
            self.filter = CuckooFilter(size)
            try:
                for k in self.keys:
                    self.filter.insert(k)
                return
            except Full:
                size *= 2

    def delete(self, digest: bytes) -> bool:
        if self.find(digest) is None:
            return False
        self.filter.delete(digest)
        del self.keys[digest]
        return True

    def row(self, bucket: int) -> pd.DataFrame:
        return pd.DataFrame({"bucket": [bucket], "filter": [self.filter.to_bytes()], "digest": [list(self.keys)],
                             "id": [[v[0] for v in self.keys.values()]], "rows": [[v[1] for v in self.keys.values()]]})

    @classmethod
    def load(cls, rows: pd.DataFrame) -> "Bucket":
        if not len(rows):
            return cls()
        r = rows.iloc[0]
        keys = {bytes(d): [None if i is None or i != i else int(i), int(n)] for d, i, n in zip(r["digest"], r["id"], r["rows"])}
        return cls(CuckooFilter.from_bytes(r["filter"]), keys)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sha): SHA-256 of the normalised whole text, as hex."""
    norm = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.sha2(norm, 256).alias("sha"))


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long"),
                                          F.lit(buckets)).cast("int"))


def insert(index: DataFrame | None, keyed: DataFrame, buckets: int) -> DataFrame:
    """Insert rows (id, sha) into an index table (None: a new one); returns the new index table."""
    salted = keyed.groupBy(F.unhex("sha").alias("digest"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    return _change(index, salted.agg(F.min("id").alias("id"), F.count("*").alias("rows")).drop("salt"), buckets)


def delete(index: DataFrame, keyed: DataFrame, buckets: int) -> DataFrame:
    """Remove the digests of (sha) rows from an index table."""
    gone = keyed.select(F.unhex("sha").alias("digest")).distinct()
    return _change(index, gone.select("digest", F.lit(None).cast("long").alias("id"), F.lit(-1).cast("long").alias("rows")),
                   buckets)


def _change(index: DataFrame | None, changes: DataFrame, buckets: int) -> DataFrame:
    def apply(bucket: Bucket, rows: Iterable[tuple]) -> Bucket:
        for digest, id_, n in rows:
            if n < 0:
                bucket.delete(bytes(digest))
            else:
                bucket.insert(bytes(digest), None if id_ is None or id_ != id_ else int(id_), int(n))
        return bucket

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        start = Bucket(CuckooFilter.sized_for(len(pdf) // 4))
        return apply(start, zip(pdf["digest"], pdf["id"].astype("object"), pdf["rows"])).row(int(key[0]))

    def update(key: tuple, old: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        return apply(Bucket.load(old), zip(pdf["digest"], pdf["id"].astype("object"), pdf["rows"])).row(int(key[0]))

    changes = _bucketed(ready(changes), buckets)
    if index is None:
        return changes.groupBy("bucket").applyInPandas(build, INDEX_SCHEMA)
    return index.groupBy("bucket").cogroup(changes.groupBy("bucket")).applyInPandas(update, INDEX_SCHEMA)


def keys(index: DataFrame) -> DataFrame:
    """(sha, keep_id, group_size) of every live digest of an index table."""
    one = F.explode(F.arrays_zip("digest", "id", "rows")).alias("k")
    return index.select(one).select(F.lower(F.hex("k.digest")).alias("sha"), F.col("k.id").alias("keep_id"),
                                    F.col("k.rows").alias("group_size"))


def bucket_count(rows: int, least: int) -> int:
    """Buckets for at most ``rows`` digests: ``least`` or more, so that none holds much over ``BUCKET_KEYS``."""
    return max(least, -(-rows // BUCKET_KEYS))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its group's keep_id and size, and whether it stays."""
    keyed = digests(docs, id_col, text_col)
    buckets = bucket_count(docs.count(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2)
    found = keys(insert(None, keyed, buckets))
    return keyed.join(found, "sha").select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"))
