"""SentencePiece encoding and decoding over a relational lattice.

A text is escaped (a leading and every inner space become U+2581) and cut into words before each run of
that mark; no piece of the vocabulary crosses such a cut. Over the distinct words of the whole input, every
substring of at most the length of the longest piece with the same first characters is exploded and equi-joined to
the piece table; the edges are grouped by shards of words, and a fold over them gives each word's ids:

* ``viterbi``: the path with the largest sum of scores (ties: the longer last piece); exact for unigram vocabularies;
* ``bpe``: merges of neighbouring pieces in order of score, for BPE vocabularies, over the same edges.

Both folds take many words of one length at a time; longer ones are folded one by one, in time that grows with
their edges. A character without a piece costs less than any piece and becomes its UTF-8 byte pieces. Tasks pack
the rows they read into compressed blocks, so a text in a third of all rows meets in no single task. A block asks
each shard for the ids of its distinct words, packed, and looks its texts' words up in the answers; words are
never a row an occurrence nor a Python object, edges never cross the network. The piece table has the size of the vocabulary file;
it is broadcast.

Defined cases: null text gives a null id list; the empty text an empty one; rows keep all their columns
and repeats; a word of any length is folded whole; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import estimate_partitions

from . import textkernel as K
from .common import blocks_of, loosen, ready, rows_of, squeeze

MARK = "▁"
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 1 << 20
HEAD = 4  # characters by which the longest piece at a place is looked up
SHORT = 32  # characters of a word that is folded together with others
WORDS = 1 << 15  # distinct words of a block that are spelled at a time
CELLS = 1 << 18  # places of edges folded at a time
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def piece_table(spark: SparkSession, model_path: str) -> DataFrame:
    """(piece, id, score, byte) of a model file's pieces; byte is null except for byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    rows = []
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            rows.append((None, i, None, int(sp.id_to_piece(i)[3:5], 16)))
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            rows.append((sp.id_to_piece(i), i, float(sp.get_score(i)), None))
    return spark.createDataFrame(rows, "piece string, id int, score double, byte int")


def words_of(text: str | None) -> list[str]:
    """Words of an escaped text, in order, without the mark that each begins with."""
    if not text:
        return []
    words = text.split(" ")
    return words if "" not in words and MARK not in text else [w[1:] for w in _WORD.findall(MARK + text.replace(" ", MARK))]


def lattice(words: DataFrame, pieces: DataFrame) -> DataFrame:
    """(shard, w, start, end, id): the pieces in the words (shard, w, word); id is -1 for a character without a piece."""
    normal = pieces.where("piece is not null")
    # No piece of HEAD characters or more fits a place but those that begin as the place does.
    heads = normal.groupBy(F.substring("piece", 1, HEAD).alias("head")).agg(F.max(F.char_length("piece")).alias("longest"))
    size = F.char_length("word")
    at = words.select("*", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
    at = at.withColumn("head", F.substring("word", F.col("start") + 1, F.lit(HEAD))).join(F.broadcast(heads), "head", "left")
    most = F.least(F.coalesce("longest", F.lit(HEAD - 1)), size - F.col("start"))
    spans = at.select("*", F.explode(F.sequence(F.lit(1), most)).alias("length")).select(
        "shard", "w", "start", (F.col("start") + F.col("length")).alias("end"), F.substring("word", F.col("start") + 1, F.col("length")).alias("piece"))
    edges = spans.join(F.broadcast(normal.select("piece", "id")), "piece", "left").where("id is not null or end = start + 1")
    return edges.select("shard", "w", "start", "end", F.coalesce("id", F.lit(-1)).alias("id"))


def _viterbi(score: np.ndarray) -> np.ndarray:
    """Cuts of words of one length: ``score[word, start, end]``, -inf without an edge. The first of equal sums wins."""
    words, size = len(score), score.shape[1] - 1
    best, back = np.zeros((words, size + 1)), np.zeros((words, size + 1), np.int64)
    every = np.arange(words)
    for end in range(1, size + 1):
        sums = best[:, :end] + score[:, :end, end]
        back[:, end] = sums.argmax(1)
        best[:, end] = sums[every, back[:, end]]
    cut = np.zeros((words, size + 1), bool)
    at = np.full(words, size)
    while at.any():
        cut[every, at] = True
        at = back[every, at]
    cut[:, 0] = True
    return cut


def _bpe(score: np.ndarray) -> np.ndarray:
    """Cuts of words of one length after all merges of neighbours, the highest score first, the leftmost of equals."""
    words, size = len(score), score.shape[1] - 1
    cut = np.ones((words, size + 1), bool)
    todo, place = np.arange(words), np.tile(np.arange(size + 1), (words, 1))
    while len(todo) and place.shape[1] > 2:
        offer = score[todo[:, None], place[:, :-2], place[:, 2:]]
        offer[place[:, 1:-1] == size] = -np.inf
        j = offer.argmax(1)
        some = offer[np.arange(len(todo)), j] > -np.inf
        todo, place, j = todo[some], place[some], j[some]
        cut[todo, place[np.arange(len(todo)), j + 1]] = False
        kept = np.arange(place.shape[1] - 1)
        place = np.take_along_axis(place, kept + (kept > j[:, None]), 1)
    return cut


def _viterbi_long(size: int, edge: dict) -> list[int]:
    """Cuts of one word; ``edge`` holds the score of (start, end)."""
    best, back = [0.0] + [-np.inf] * size, [0] * (size + 1)
    for (a, b) in sorted(edge, key=lambda x: (x[1], x[0])):
        if best[a] + edge[a, b] > best[b]:
            best[b], back[b] = best[a] + edge[a, b], a
    out = [size]
    while out[-1]:
        out.append(back[out[-1]])
    return out[::-1]


def _bpe_long(size: int, edge: dict) -> list[int]:
    """Cuts of one word after all merges."""
    right = {i: i + 1 for i in range(size)}
    left = {i + 1: i for i in range(size)}
    queue = []

    def offer(a):
        b = right.get(a)
        c = right.get(b) if b is not None else None
        found = edge.get((a, c)) if c is not None else None
        if found is not None:
            heapq.heappush(queue, (-found, a, b, c))

    for i in range(size):
        offer(i)
    while queue:
        _, a, b, c = heapq.heappop(queue)
        if right.get(a) != b or right.get(b) != c:
            continue
        right[a], left[c] = c, a
        del right[b], left[b]
        offer(a)
        if a in left:
            offer(left[a])
    return [*sorted(right), size]


_FOLDS = {"viterbi": (_viterbi, _viterbi_long), "bpe": (_bpe, _bpe_long)}


def fold(size: np.ndarray, edges: tuple, score: np.ndarray, methods: list[str]) -> list[np.ndarray]:
    """Per method the lengths of the words' pieces, word after word, by their sizes and edges (w, start, end, id), sorted by w."""
    w, start, end, ids = edges
    first = np.searchsorted(w, np.arange(len(size) + 1))
    found = [([], [], []) for _ in methods]  # word, start and end of the pieces taken
    for n in np.unique(size[size <= SHORT]):
        same = np.flatnonzero(size == n)
        most = max(1, CELLS // (n + 1) ** 2)
        for mine in (same[i:i + most] for i in range(0, len(same), most)):
            k = np.diff(first)[mine]
            row = np.repeat(np.arange(len(mine)), k)
            at = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(first[mine], k)
            table = np.full((len(mine), n + 1, n + 1), -np.inf)
            table[row, start[at], end[at]] = score[ids[at]]
            for out, m in zip(found, methods):
                row, cut = np.nonzero(_FOLDS[m][0](table))
                inner = row[1:] == row[:-1]
                for x, y in zip(out, (mine[row[1:][inner]], cut[:-1][inner], cut[1:][inner])):
                    x.append(y)
    for x in np.flatnonzero(size > SHORT):
        at = slice(first[x], first[x + 1])
        edge = dict(zip(zip(start[at].tolist(), end[at].tolist()), score[ids[at]].tolist()))
        for out, m in zip(found, methods):
            cut = np.array(_FOLDS[m][1](int(size[x]), edge))
            for x_, y in zip(out, (np.full(len(cut) - 1, x), cut[:-1], cut[1:])):
                x_.append(y)
    out = []
    for of, a, b in ([np.concatenate([np.zeros(0, np.int64), *x]) for x in y] for y in found):
        by = np.lexsort((a, of))
        out.append((b - a)[by])
    return out


class _Vocabulary(NamedTuple):
    """What tasks need of the piece table: the pieces, their ids, the ids of the 256 bytes, and scores by id (the last: no piece)."""

    pieces: pa.Array
    ids: np.ndarray
    spelled: np.ndarray
    score: np.ndarray


def _runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each run, one run after another."""
    return np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)


def _marked(words: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(pa.scalar(MARK, words.type), words, pa.scalar("", words.type))


def _ids(words: pa.Array, lengths: np.ndarray, known: _Vocabulary) -> pa.ListArray:
    """The ids of each word, from the lengths of the pieces of all words."""
    (data, offs), cut = _parts(_marked(words)), np.concatenate(([0], np.cumsum(lengths)))
    chars = np.append(np.flatnonzero((data[:offs[-1]] & 0xC0) != 0x80), offs[-1])  # where each character begins
    at = chars[cut]
    spelt = pa.Array.from_buffers(words.type, len(lengths), [None, pa.py_buffer(at.astype(offs.dtype)), pa.py_buffer(data)])
    found = pc.index_in(spelt, known.pieces.cast(words.type))
    lost = found.is_null().to_numpy(zero_copy_only=False)
    count = np.where(lost, np.diff(at), 1)
    end = np.concatenate(([0], np.cumsum(count)))
    ids = np.empty(end[-1], np.int32)
    ids[end[:-1][~lost]] = known.ids[found.drop_null().to_numpy(zero_copy_only=False)]
    ids[_runs(end[:-1][lost], count[lost])] = known.spelled[data[_runs(at[:-1][lost], count[lost])]]
    return pa.ListArray.from_arrays(pa.array(end[np.searchsorted(at, offs)], pa.int32()), pa.array(ids))


def _parts(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings, and where each begins, with the last one's end."""
    wide = pa.types.is_large_string(a.type) or pa.types.is_large_binary(a.type)
    offs = np.frombuffer(a.buffers()[1], np.int64 if wide else np.int32, len(a) + 1, a.offset * (8 if wide else 4)) if len(a) else np.zeros(1, np.int32)
    return np.frombuffer(a.buffers()[2] or b"", np.uint8), offs


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, and their number by text."""
    lists = pc.split_pattern(texts, " ")
    empty = pc.equal(pc.binary_length(lists.flatten()), 0).to_numpy(zero_copy_only=False)
    of = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    odd = np.union1d(of[empty], np.flatnonzero(pc.match_substring(texts, MARK).fill_null(False).to_numpy(zero_copy_only=False)))
    if len(odd):
        other = pa.array([words_of(t) for t in texts.take(pa.array(odd)).to_pylist()], lists.type)
        take = np.arange(len(texts))
        take[odd] = len(texts) + np.arange(len(odd))
        lists = pa.concat_arrays([lists, other]).take(pa.array(take))
    return lists.flatten(), pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)


def _asked(words: pa.Array, shards: int) -> tuple[pa.Array, np.ndarray]:
    """Distinct words, ordered by shard and word, and where each shard begins, with the last one's end."""
    words = words.take(pc.sort_indices(words))
    (data, offs), shard = _parts(words), np.zeros(len(words), np.int64)
    for part in range(0, len(words), 1 << 14):
        o = offs[part:part + (1 << 14) + 1].astype(np.int64)
        h = K.FIRST.ranges(K.FIRST.prefix(data[o[0]:o[-1]]), o[:-1] - o[0], o[1:] - o[0])
        shard[part:part + len(o) - 1] = h % K.U64(shards)
    by = np.argsort(shard, kind="stable")
    return words.take(pa.array(by)), np.searchsorted(shard[by], np.arange(shards + 1))


def _pack(words: pa.Array) -> bytes:
    sink, batch = pa.BufferOutputStream(), pa.record_batch({"word": words})
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def encode(df: DataFrame, pieces: DataFrame, text_col: str = "text", method: str = "viterbi", out_col: str = "ids") -> DataFrame:
    """``df`` with the ids of its whole texts in ``out_col``."""
    return encode_all(df, pieces, {out_col: method}, text_col)


def encode_all(df: DataFrame, pieces: DataFrame, methods: dict[str, str], text_col: str = "text",
               blocks: int | None = None) -> DataFrame:
    """``df`` with one id column per entry of ``methods`` (column -> method), all from one lattice."""
    spelled = [r["id"] for r in pieces.where("byte is not null").orderBy("byte").collect()]  # 256 ids
    known = {r["piece"]: (r["id"], r["score"]) for r in pieces.where("piece is not null").collect()}  # the vocabulary
    ids = np.array([i for i, _ in known.values()], np.int32)
    score = np.full(ids.max() + 2, min(x for _, x in known.values()) - 10.0)
    score[ids] = [x for _, x in known.values()]
    shared = df.sparkSession.sparkContext.broadcast(_Vocabulary(pa.array(list(known), pa.string()), ids, np.array(spelled, np.int32), score))
    shards = blocks or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), estimate_partitions(df, SHARD_BYTES))
    plain = isinstance(df.schema[text_col].dataType, T.StringType)
    text = text_col if plain else "__text"
    packed = blocks_of(df if plain else df.withColumn(text, F.col(text_col).cast("string")), text, BLOCK_BYTES).repartition("block")

    def texts_of(rows: pa.Table) -> pa.Array:
        return pa.concat_arrays(rows.column(text).chunks)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                pa.default_memory_pool().release_unused()
                words, at = _asked(_split(texts_of(rows_of(rows.as_buffer())))[0].unique(), shards)
                some = np.flatnonzero(np.diff(at)).tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * len(some), pa.int64()), pa.array(some, pa.int32()),
                    pa.array([_pack(words[at[s]:at[s + 1]]) for s in some], pa.binary())], ["block", "shard", "words"])

    def distinct(asked: pa.Table) -> tuple[pa.Array, list[np.ndarray]]:
        """The distinct words, sorted, and the places of each block's words among them."""
        each = [rows_of(x.as_buffer()).column("word").combine_chunks() for x in asked["words"]]
        coded = pa.concat_arrays(each).dictionary_encode()
        by = pc.sort_indices(coded.dictionary).to_numpy()
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        places = place[coded.indices.to_numpy()]
        return coded.dictionary.take(pa.array(by)), np.split(places, np.cumsum([len(x) for x in each])[:-1])

    def vocabulary(asked: pa.Table) -> pa.Table:
        words = _marked(distinct(asked)[0])
        return pa.table({"shard": pa.array(np.full(len(words), asked["shard"][0].as_py()), pa.int32()),
                         "w": pa.array(np.arange(len(words)), pa.int32()), "word": words.cast(pa.string())})

    names = sorted(set(methods.values()))

    def answer(edges: pa.Table, asked: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        words, places = distinct(asked)
        cols = [edges[c].to_numpy() for c in ("w", "start", "end", "id")]
        by = np.argsort(cols[0], kind="stable")
        size = pc.utf8_length(words).to_numpy().astype(np.int64) + 1
        folded = fold(size, tuple(c[by] for c in cols), shared.value.score, names)
        cuts = []  # per method the number of each word's first piece
        for x in folded:
            cuts.append(np.searchsorted(np.concatenate(([0], np.cumsum(x))), np.concatenate(([0], np.cumsum(size)))))
        out = []
        for mine in places:
            told = [x[_runs(cut[mine], np.diff(cut)[mine])] for x, cut in zip(folded, cuts)]
            out.append([v for x in told for v in (len(x), squeeze(x.astype("<i8")))])
        return pa.Table.from_arrays([asked["block"], asked["shard"], *(pa.array(c) for c in zip(*out))], reply.names)

    reply = T.StructType([T.StructField("block", T.LongType()), T.StructField("shard", T.IntegerType()), *(
        T.StructField(f"{m}_{c}", kind) for m in names for c, kind in (("n", T.LongType()), ("lengths", T.BinaryType())))])
    # Numbers of partitions are given, since the edges are many more than the words that Spark sees.
    asked = packed.mapInArrow(ask, "block long, shard int, words binary").repartitionById(shards, F.col("shard"))
    words = asked.groupBy("shard").applyInArrow(vocabulary, "shard int, w int, word string").repartitionById(shards, F.col("shard"))
    told = lattice(words, pieces).groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(answer, reply)
    kept = [c for c in df.columns if c not in methods]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(c, T.ArrayType(T.IntegerType())) for c in methods])

    def look_up(blocks: pa.Table, told: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        (rows,) = map(rows_of, (x.as_buffer() for x in blocks["rows"]))
        texts = texts_of(rows)
        flat, count = _split(texts)
        coded = flat.dictionary_encode()
        words, at = _asked(coded.dictionary, shards)
        word = pc.index_in(coded.dictionary, words).take(coded.indices)
        del flat, coded
        ends, null, ids = np.concatenate(([0], np.cumsum(count)))[1:], texts.is_null(), {}
        shard = told["shard"].to_numpy()
        parts = [p for p in np.array_split(np.argsort(shard), len(words) // WORDS + 1) if len(p)]
        for m in names:
            each = [pa.array([], pa.list_(pa.int32()))]
            for p in parts:
                lengths = [loosen(told[f"{m}_lengths"][r].as_buffer(), told[f"{m}_n"][r].as_py(), "<i8") for r in p.tolist()]
                each.append(_ids(words[at[shard[p[0]]]:at[shard[p[-1]] + 1]], np.concatenate(lengths), shared.value))
            of = pa.concat_arrays(each).take(word)
            offs = np.concatenate(([0], of.offsets.to_numpy()[ends]))
            ids[m] = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), of.values, mask=null)
        out = pa.Table.from_arrays([rows.column(c) for c in kept] + [ids[m] for m in methods.values()], [*kept, *methods])
        return pa.concat_tables(out.slice(k, 100) for k in range(0, out.num_rows, 100))  # Spark reads 100 rows at a time

    return packed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(look_up, schema)


def decode(df: DataFrame, pieces: DataFrame, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its id lists in ``out_col``: pieces are joined, bytes assembled, spaces restored."""
    raw = F.coalesce(F.encode("piece", "UTF-8"), F.unhex(F.lpad(F.hex("byte"), 2, "0")))
    table = {r["id"]: bytes(r["raw"]) for r in pieces.select("id", raw.alias("raw")).collect()}  # the vocabulary
    spelt = pa.array([table.get(i, b"") for i in range(max(table) + 1)] + [b""], pa.binary())  # the last: any other id
    shared = ready(df).sparkSession.sparkContext.broadcast(spelt)
    kept = [c for c in df.columns if c != out_col]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(ids_col))
            ids = col.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            data, offs = _parts(of.take(pa.array(np.where((ids < 0) | (ids >= len(of)), len(of) - 1, ids))))
            offs = offs[np.concatenate(([0], np.cumsum(pc.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False))))]
            texts = pa.Array.from_buffers(pa.binary(), len(col), [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(data)])
            texts = pc.replace_substring(texts, MARK.encode(), b" ").cast(pa.string())  # fails on invalid UTF-8
            texts = pc.replace_substring_regex(texts, r"\A ", "", max_replacements=1)
            texts = pc.if_else(col.is_null(), pa.scalar(None, pa.string()), texts)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), texts], schema.names)

    return df.mapInArrow(run, schema)
