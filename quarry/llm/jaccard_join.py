"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

A document is the set of 64-bit hashes of its distinct word shingles. The global order is (estimated
frequency, hash), the frequency from a count sketch over all documents with a fixed number of cells;
any order gives the same result, a good one puts common shingles last. The order is cut into fragments:

1. Documents with equal sets form a class, represented by the smallest id.
2. Seeds: representatives that agree on three neighbouring minima of a one-permutation sketch are
   linked to the smallest of them if their exact overlap allows it. This joins large groups of near
   copies with a number of pairs linear in the group.
3. Each representative's prefix (the shingles that any partner must share at least one of) is cut at the
   fragment borders and sent to its fragments as packed arrays. A fragment drops shingles with one holder
   and returns the rest. A document looks for partners outside its component by the rarest of them, as
   many as a link calls for; a pair whose shared prefix shingles cannot reach the threshold is dropped.
4. The surviving pairs count overlaps fragment by fragment over their whole sets, summed per pair, and
   link when ``100 * overlap >= 80 * union``, in integers: first each document's most promising pair, then
   every pair still between two components. Components of all links give the classes.

Nothing is sampled or capped; the seeds only save work. Sets travel only for documents that occur in a
candidate pair (a Bloom filter of fixed size selects them; a false hit is dropped by the join).

Defined cases: null text is empty; a document without words has an empty set and no links; one to four
words are one shingle; rows without an id get a null component; rows sharing an id are one node; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import estimate_partitions

from . import textkernel as K
from .common import bloom_of, pin, ready
from .components import components

WORDS, NUM, DEN = 5, 80, 100
SKETCH_CELLS, SKETCH_BLOCKS = 1 << 20, 64
MINIMA, BAND = 32, 3
BLOOM_BITS = 1 << 25
BLOCK_TOKENS = 250_000
OVERLAP_FRAGMENTS = 2
SIZE_STEP = 1.1


def _need(a, b):
    """Smallest overlap of sets of sizes a and b that reaches the threshold."""
    return -((-NUM * (a + b)) // (DEN + NUM))


def prefix_length(n):
    """Shingles of a set of n, in the global order, of which any partner shares at least one."""
    return n - -((-NUM * n) // DEN) + 1


def profile(docs: DataFrame) -> DataFrame:
    """Per row (kind 0): id, n, digest of the set, seed keys; per task (kind 1): blocks of the count sketch."""
    cells = SKETCH_CELLS // SKETCH_BLOCKS
    edges = (np.arange(MINIMA, dtype=np.uint64) << K.U64(64 - MINIMA.bit_length() + 1))
    names = ["kind", "id", "n", "digest", "seeds", "cell", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH_CELLS, np.int64)
        for batch in batches:
            for rows, data, offs in K.text_chunks(batch):
                n, digest, seeds = [], [], []
                sets = K.shingle_sets(data, offs, WORDS)
                if sets:
                    sketch += np.bincount((np.concatenate(sets) % K.U64(SKETCH_CELLS)).astype(np.int64), minlength=SKETCH_CELLS)
                for s in sets:
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    at = np.searchsorted(s, edges)
                    full = np.diff(np.append(at, len(s))) > 0
                    least = np.where(full, s[np.minimum(at, max(len(s) - 1, 0))], K.U64(0)) if len(s) else np.zeros(MINIMA, np.uint64)
                    first = np.arange(0, MINIMA - BAND + 1, BAND)
                    whole = full[first] & full[first + 1] & full[first + 2]
                    key = K.combine(least, BAND, first) + first.astype(np.uint64)
                    seeds.append(key[whole].view(np.int64))
                k = rows.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0] * k, pa.int32()), K.column(rows, "id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                     pa.array(seeds, pa.list_(pa.int64())), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
        on = [i for i in range(SKETCH_BLOCKS) if sketch[i * cells:(i + 1) * cells].any()]
        m = len(on)
        yield pa.RecordBatch.from_arrays(
            [pa.array([1] * m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()),
             pa.nulls(m, pa.list_(pa.int64())), pa.array(on, pa.int32()),
             pa.array([sketch[i * cells:(i + 1) * cells].astype("<i8").tobytes() for i in on], pa.binary())], names)

    return docs.mapInArrow(run, "kind int, id long, n long, digest binary, seeds array<long>, cell int, counts binary")


def _order_table(profiles: DataFrame) -> np.ndarray:
    """The summed sketch as a rank per cell, one byte each: a size that does not depend on the data."""
    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(SKETCH_CELLS // SKETCH_BLOCKS, np.int64)
        for x in table["counts"]:
            total += np.frombuffer(x.as_py(), "<i8")
        return pa.table({"cell": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    sketch = np.zeros((SKETCH_BLOCKS, SKETCH_CELLS // SKETCH_BLOCKS), np.int64)
    parts = profiles.where("kind = 1").select("cell", "counts").groupBy("cell").applyInArrow(add, "cell int, counts binary")
    for r in parts.collect():  # SKETCH_BLOCKS rows
        sketch[r["cell"]] = np.frombuffer(r["counts"], "<i8")
    flat = sketch.ravel()
    # Four rank steps per doubling of what a cell holds beyond chance; below that, hashes alone decide.
    mean = flat.mean()
    beyond = flat - (mean + 4 * np.sqrt(mean) + 2)
    return np.where(beyond > 0, 1 + 4 * np.log2(np.maximum(beyond, 1)).astype(np.int64), 0).astype(np.uint8)


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, n, own, fragment, part) of the documents in ``ids`` (and of few others): their sets cut into fragments."""
    bits = docs.sparkSession.sparkContext.broadcast(bloom_of(ids, "id", BLOOM_BITS).bits)  # BLOOM_BITS / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = K.Bloom(bits.value)
        shift = K.U64(64 - OVERLAP_FRAGMENTS.bit_length() + 1)
        for batch in batches:
            batch = batch.filter(pa.array(bloom.has(K.column(batch, "id").to_numpy())))
            for rows, data, offs in K.text_chunks(batch):
                out = ([], [], [], [], [])
                for i, s in zip(K.column(rows, "id").to_pylist(), K.shingle_sets(data, offs, WORDS)):
                    own = int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                    cut = np.searchsorted(s >> shift, np.arange(1, OVERLAP_FRAGMENTS, dtype=np.uint64))
                    for f, part in enumerate(np.split(s.view(np.int64), cut)):
                        for col, v in zip(out, (i, len(s), own, f, part)):
                            col.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                     pa.array(out[3], pa.int32()), pa.array(out[4], pa.list_(pa.int64()))],
                    ["id", "n", "own", "fragment", "part"])

    return docs.mapInArrow(run, "id long, n long, own long, fragment int, part array<long>")


def _links(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: overlaps counted per fragment and summed per pair."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    sets = pin(_sets(docs, ids))
    left = sets.select(F.col("id").alias("a"), "fragment", F.col("n").alias("na"), F.col("own").alias("ka"), F.col("part").alias("pa"))
    right = sets.select(F.col("id").alias("b"), "fragment", F.col("n").alias("nb"), F.col("own").alias("kb"), F.col("part").alias("pb"))
    per = (pairs.join(left, "a").join(right, ["b", "fragment"])
           .select("a", "b", "na", "nb", "ka", "kb", "fragment", F.size(F.array_intersect("pa", "pb")).cast("long").alias("c")))
    # A maximum within the fragment: rows that repeat an id and a text count once.
    shared = sum((F.coalesce(F.max(F.when(F.col("fragment") == f, F.col("c"))), F.lit(0)) for f in range(OVERLAP_FRAGMENTS)), F.lit(0))
    return (per.groupBy("a", "b", "na", "nb", "ka", "kb").agg(shared.alias("shared"))
            .where(F.col("shared") * DEN >= (F.col("na") + F.col("nb") - F.col("shared")) * NUM).select("a", "b").distinct())


def _seed_pairs(reps: DataFrame) -> DataFrame:
    keyed = reps.select("rep", F.explode("seeds").alias("key"))
    common = keyed.groupBy("key").agg(F.count("*").alias("k")).where("k > 1")
    keyed = pin(keyed.join(common, "key"))
    # The hub of a key is the holder whose keys are the most common: close to the middle of a group of copies.
    weight = keyed.groupBy("rep").agg(F.sum("k").alias("weight"))
    keyed = keyed.join(weight, "rep")
    hubs = keyed.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("order"), "rep")).alias("hub"))
    # One pair for each document, with the heaviest hub of its keys.
    best = keyed.join(hubs, "key").groupBy("rep").agg(F.min("hub")["rep"].alias("a"))
    return best.where("a != rep").select("a", F.col("rep").alias("b"))


def _shared_prefixes(docs: DataFrame, reps: DataFrame, order: np.ndarray, fragments: int) -> DataFrame:
    """(token, id, n, end): prefix shingles with at least two holders, fragment by fragment.

    ``end`` is the place of the prefix's last shingle in the global order.
    """
    sc = docs.sparkSession.sparkContext
    bits = sc.broadcast(bloom_of(reps, "rep", BLOOM_BITS).bits)
    ranks = sc.broadcast(order)
    fields = [("token", "<u8"), ("id", "<i8"), ("n", "<i8"), ("end", "<i8")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom, rank = K.Bloom(bits.value), ranks.value
        held, count = [], 0

        def flush():
            token, *rest = (np.concatenate(x) for x in zip(*held))
            held.clear()
            f = (token >> K.U64(32)) % K.U64(fragments)
            by = np.argsort(f, kind="stable")
            f = f[by]
            first = np.flatnonzero(np.append(True, f[1:] != f[:-1]))
            cols = [pa.array([x.tobytes() for x in np.split(v[by], first[1:])], pa.binary()) for v in (token, *rest)]
            return pa.RecordBatch.from_arrays([pa.array(f[first].astype(np.int32)), *cols], ["fragment"] + [x for x, _ in fields])

        for batch in batches:
            batch = batch.filter(pa.array(bloom.has(K.column(batch, "id").to_numpy())))
            for rows, data, offs in K.text_chunks(batch):
                for i, s in zip(K.column(rows, "id").to_pylist(), K.shingle_sets(data, offs, WORDS)):
                    if not len(s):
                        continue
                    p = prefix_length(len(s))
                    r = rank[(s % K.U64(SKETCH_CELLS)).astype(np.int64)]
                    at = np.flatnonzero(r == 0)  # s is in hash order, so is each rank
                    if len(at) < p:
                        at = np.argsort(r, kind="stable")
                    t = s[at[:p]]
                    end = (int(r[at[p - 1]]) << 55) | (int(t[-1]) >> 9)
                    held.append((t, *(np.full(p, v, np.int64) for v in (i, len(s), end))))
                    count += len(t)
                if count >= BLOCK_TOKENS:
                    yield flush()
                    count = 0
        if held:
            yield flush()

    def shared(key: tuple, table: pa.Table) -> pa.Table:
        token, *rest = (np.concatenate([np.frombuffer(x.as_py(), kind) for x in table[name]]) for name, kind in fields)
        by = np.argsort(token, kind="stable")
        t = token[by]
        same = t[1:] == t[:-1]
        many = np.append(same, False) | np.append(False, same)
        by = by[many]
        return pa.table({"token": token[by].view(np.int64), **{x: v[by] for (x, _), v in zip(fields[1:], rest)}})

    return (docs.mapInArrow(cut, "fragment int, token binary, id binary, n binary, end binary").groupBy("fragment")
            .applyInArrow(shared, "token long, id long, n long, end long"))


def _size_class(n):
    return F.floor(F.log(n) / F.log(F.lit(SIZE_STEP))).cast("int")


def _rest_pairs(shared: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs (a, b, c) of different components whose prefix overlap c still allows a link.

    Of a pair, let x be the document whose prefix ends first. All its prefix shingles that both hold are
    in both prefixes, so the overlap is at most those plus what lies beyond x's prefix (``room``), and the
    pair needs ``k = need - room`` of them. Only open shingles count, those held by two components. If x has
    m of them, any m - k + 1 hold one that the pair shares: x looks for partners by its rarest ones alone.
    ``k`` grows with the partner's size, so x does so once for each size class of partners. Shingles common
    in a large group of near copies that do not link are thereby looked up by few of them.
    """
    held = (shared.join(comps.select(F.col("node").alias("id"), "component"), "id", "left")
            .select("token", "id", "n", "end", F.coalesce("component", "id").alias("component")))
    open_ = (held.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("holders"))
             .where("lo != hi").select("token", "holders"))
    # One row per document, with at most as many shingles as its prefix has, the rarest first.
    own = pin(held.join(open_, "token").groupBy("id", "n", "end", "component")
              .agg(F.sort_array(F.collect_list(F.struct("holders", "token")))["token"].alias("held")))
    side = {s: own.select(*(F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "end", "component", "held")), F.size("held").alias(f"m_{s}"))
            for s in "xy"}
    need = f"(({NUM} * (n_x + n_y) + {DEN + NUM - 1}) div {DEN + NUM})"
    room = f"(({NUM} * n_x + {DEN - 1}) div {DEN} - 1)"
    least, most = F.expr(f"({NUM} * n_x + {DEN - 1}) div {DEN}"), F.expr(f"{DEN} * n_x div {NUM}")
    low = F.greatest(least, F.floor(F.pow(F.lit(SIZE_STEP), "step")) - 1)  # at most the smallest size of the class
    x = (side["x"].withColumn("step", F.explode(F.sequence(_size_class(least), _size_class(most)))).withColumn("n_y", low)
         .withColumn("looked", F.expr(f"m_x + 1 - greatest({need} - {room}, 1)")).where("looked > 0")
         .select("id_x", "n_x", "end_x", "component_x", "m_x", "step", F.posexplode(F.expr("slice(held_x, 1, int(looked))")).alias("at", "token")))
    y = side["y"].select("id_y", "n_y", "end_y", "component_y", "m_y", _size_class(F.col("n_y")).alias("step"), F.explode("held_y").alias("token"))
    met = (x.join(y, ["token", "step"]).where(
        f"component_x != component_y and (end_x < end_y or (end_x = end_y and id_x < id_y)) and {DEN} * n_x >= {NUM} * n_y and "
        f"{DEN} * n_y >= {NUM} * n_x and least(m_x - at, m_y) + {room} >= {need}")
        .select("id_x", "n_x", "end_x", "id_y", "n_y", "end_y").distinct())
    counted = (met.join(side["x"].select("id_x", "n_x", "end_x", "held_x"), ["id_x", "n_x", "end_x"])
               .join(side["y"].select("id_y", "n_y", "end_y", "held_y"), ["id_y", "n_y", "end_y"])
               .withColumn("c", F.size(F.array_intersect("held_x", "held_y"))).where(f"c + {room} >= {need}"))
    return counted.groupBy(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).agg(F.max("c").alias("c"))


def _best_pairs(pairs: DataFrame) -> DataFrame:
    """Of the pairs (a, b, c), the one with the largest count for each document: linear in a group of copies."""
    first = F.max_by(F.struct("a", "b"), F.struct("c", -F.col("a"), -F.col("b"))).alias("p")
    best = pairs.groupBy("a").agg(first).select("p.*").union(
        pairs.groupBy(F.col("b").alias("own")).agg(first).select("p.*"))
    return best.distinct()


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose documents are not yet in one component."""
    for x in "ab":
        pairs = pairs.join(comps.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")), x, "left")
    return pairs.where("coalesce(ca, a) != coalesce(cb, b)").select("a", "b")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable by links)."""
    src = ready(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    named = src.where("id is not null")
    profiles = pin(profile(src))
    rows = profiles.where("kind = 0").select("id", "n", "digest", "seeds")
    classes = (rows.where("id is not null and n > 0").groupBy("digest")
               .agg(F.min("id").alias("rep"), F.min_by("seeds", "id").alias("seeds")))
    reps = pin(classes)

    first = pin(_links(named, pin(_seed_pairs(reps))))
    known = components(first)
    fragments = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), estimate_partitions(docs, 32 << 20))
    shared = pin(_shared_prefixes(named, reps, _order_table(profiles), fragments))
    rest = pin(_rest_pairs(shared, known))
    second = pin(_links(named, pin(_best_pairs(rest))))
    third = _links(named, pin(_apart(rest, components(first.union(second)))))
    # Rows that share an id but not a set tie their classes together.
    own = rows.where("id is not null and n > 0").join(reps.select("digest", "rep"), "digest")
    ties = own.where("id != rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    final = components(first.union(second).union(third).union(ties)).withColumnRenamed("node", "id")
    return (rows.join(final, "id", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id; rows without an id stay."""
    gone = (join(docs, id_col, text_col).where(F.col(id_col) != F.col("component_id"))
            .select(F.col(id_col).alias("__gone")).distinct())
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__gone"), "left_anti")
