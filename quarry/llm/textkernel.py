"""Vectorised text primitives over Arrow string columns (numpy, used inside Spark tasks).

A chunk is a run of rows whose UTF-8 bytes lie in one ``uint8`` array ``data``; row ``i`` is
``data[offs[i]:offs[i + 1]]``. Null texts are empty rows. Hashes are 64-bit polynomial hashes of
byte ranges, finished with a bit mixer, so equal bytes give equal hashes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 18

# ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SPACE = np.zeros(256, bool)
SPACE[list(WHITE)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising bit mixer on uint64 (xor-shift and odd multiplications)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class RangeHash:
    """Polynomial hash of any byte range of a chunk after one prefix sum."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
        self.base = int(rng.integers(1, 1 << 60)) * 8 + 5  # odd: it has an inverse modulo 2**64
        self.inverse = pow(self.base, -1, 1 << 64)
        self.power = np.ones(1, np.uint64)
        self.back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            m = max(n, CHUNK_BYTES + 1024)
            self.power = np.full(m, self.base, np.uint64)
            self.back = np.full(m, self.inverse, np.uint64)
            self.power[0] = self.back[0] = 1
            np.multiply.accumulate(self.power, out=self.power)
            np.multiply.accumulate(self.back, out=self.back)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        self._grow(n + 1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.power[:n], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (prefix[ends] - prefix[starts]) * self.back[starts]
        return mix(h ^ ((ends - starts).astype(np.uint64) * U64(0x9E3779B97F4A7C15)))


FIRST, SECOND = RangeHash(0x51A2), RangeHash(0x7C3D)
_MULT = np.random.default_rng(0x2B).integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)


def text_chunks(batch: pa.RecordBatch, col: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple]:
    """Cut a batch into (rows, data, offs) runs of about ``limit`` bytes; one long row stays whole."""
    arr = batch.column(batch.schema.get_field_index(col))
    if arr.null_count:
        arr = arr.fill_null("")
    big = pa.types.is_large_string(arr.type)
    n = len(arr)
    if n == 0:
        return
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if big else np.int32, n + 1 + arr.offset)[arr.offset:].astype(np.int64)
    whole = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1))
        yield batch.slice(i, j - i), whole[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def _edges(data: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` that cross no row border."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z
    first = np.empty(n, bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    first[offs[:-1][offs[:-1] < n]] = True
    last = np.empty(n, bool)
    last[-1] = True
    np.logical_not(inside[1:], out=last[:-1])
    last[offs[1:][offs[1:] > 0] - 1] = True
    return np.flatnonzero(inside & first), np.flatnonzero(inside & last) + 1


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, woff): words between ASCII white space; row i has words woff[i]:woff[i+1]."""
    starts, ends = _edges(data, offs, ~SPACE[data])
    return starts, ends, np.searchsorted(starts, offs)


def lines(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, loff): pieces between line feeds; a row has one more line than line feeds."""
    cut = np.flatnonzero(data == 10)
    cuts = np.searchsorted(cut, offs)  # line feeds before each row
    per = np.diff(cuts) + 1
    loff = np.concatenate(([0], np.cumsum(per)))
    starts = np.empty(loff[-1], np.int64)
    ends = np.empty(loff[-1], np.int64)
    first = np.zeros(loff[-1], bool)
    first[loff[:-1]] = True
    starts[first] = offs[:-1]
    starts[~first] = cut + 1
    last = np.zeros(loff[-1], bool)
    last[loff[1:] - 1] = True
    ends[last] = offs[1:]
    ends[~last] = cut
    return starts, ends, loff


def strip(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges without the ASCII white space at both ends (empty ranges stay empty)."""
    full = np.flatnonzero(~SPACE[data])
    if len(full) == 0:
        return starts, starts.copy()
    i, j = np.searchsorted(full, starts), np.searchsorted(full, ends)
    some = j > i
    s = np.where(some, full[np.minimum(i, len(full) - 1)], starts)
    e = np.where(some, full[np.maximum(j - 1, 0)] + 1, starts)
    return s, e


def code_points(data: np.ndarray) -> np.ndarray:
    """Prefix counts of code points: ``c[e] - c[s]`` is the length of a range in characters."""
    c = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=c[1:])
    return c


def combine(wh: np.ndarray, k: int, first: np.ndarray, length: np.ndarray | None = None) -> np.ndarray:
    """Hash of the word run that begins at each index of ``first``: ``k`` words, or ``length`` of them."""
    h = np.zeros(len(first), np.uint64)
    for j in range(k):
        if length is None:
            h += wh[first + j] * _MULT[j]
        else:
            on = length > j
            h[on] += wh[first[on] + j] * _MULT[j]
    n = np.full(len(first), k, np.uint64) if length is None else length.astype(np.uint64)
    return mix(h + n * U64(0xD6E8FEB86659FD93))


def shingles(wh: np.ndarray, woff: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, soff): k-word shingles of each row; a row of 1..k-1 words gives its whole sequence."""
    nw = np.diff(woff)
    per = np.where(nw >= k, nw - k + 1, (nw > 0).astype(np.int64))
    soff = np.concatenate(([0], np.cumsum(per)))
    row = np.repeat(np.arange(len(nw)), per)
    first = woff[:-1][row] + (np.arange(soff[-1]) - soff[:-1][row])
    out = np.zeros(soff[-1], np.uint64)
    full = nw[row] >= k
    out[full] = combine(wh, k, first[full])
    out[~full] = combine(wh, k, first[~full], nw[row][~full])
    return out, soff


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row, on text with A-Z lower-cased."""
    low = LOWER[data]
    s, e, woff = words(low, offs)
    h, soff = shingles(FIRST.ranges(FIRST.prefix(low), s, e), woff, k)
    return [np.unique(h[a:b]) for a, b in zip(soff[:-1], soff[1:])]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


class Bloom:
    """Bloom filter over int64 ids with a fixed number of bits; it answers no only for absent ids."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def slots(ids: np.ndarray, size: int) -> np.ndarray:
        h = mix(ids.astype(np.int64).view(np.uint64) + U64(0x9E3779B97F4A7C15))
        step = (h >> U64(32)) | U64(1)
        return np.stack([(h + step * U64(i)) % U64(size) for i in range(4)])

    @classmethod
    def empty(cls, bits: int) -> "Bloom":
        return cls(np.zeros(bits // 8, np.uint8))

    def add(self, ids: np.ndarray) -> None:
        at = self.slots(ids, len(self.bits) * 8).ravel()
        np.bitwise_or.at(self.bits, (at >> U64(3)).astype(np.int64), (1 << (at & U64(7))).astype(np.uint8))

    def has(self, ids: np.ndarray) -> np.ndarray:
        at = self.slots(ids, len(self.bits) * 8)
        return ((self.bits[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1).all(axis=0)
