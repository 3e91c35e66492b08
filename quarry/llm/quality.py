"""Quality rules: exact text counts, then a calibrated n-gram logistic regression.

The model sees hashed word unigrams and hashed trigrams of code points, each as a share of the document's own
n-grams, so its margin does not grow with length. It is fitted with MLlib on at most ``max_rows``
labelled documents (lowest hash of the id first); a fifth of them is held back to fit the
calibration (Platt scaling). Weights are ``2 * DIMS`` numbers, whatever the corpus. Every whole
document is scored in Arrow batches against a fixed probability threshold.

Defined cases: null or empty text has no words and fails the base rules; null ids and repeated rows
are scored like any row; labels without a quality, an id or a document are ignored; with no labels
of both classes there is no model and the base rules decide alone (probability null).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path

from . import textkernel as K
from .common import ready

BITS = 15
DIMS = 1 << BITS
MIN_WORDS, MAX_REPEAT_PCT, KEEP_FROM, WINDOW = 20, 30, 0.5, 8
FIT_PARTS = 4  # partitions of the labelled sample
SHARE = 40.0  # a feature is SHARE times its share of the row's n-grams: puts weights in the range the penalty expects
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # words, then trigrams
    intercept: float
    scale: float  # calibrated logit = scale * margin + shift
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * margin + self.shift, -60, 60)))


def _row_sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    c = np.concatenate(([0], np.cumsum(values)))
    return c[offs[1:]] - c[offs[:-1]]


def _slots(data, offs, prefix, wh, woff):
    """Feature slots with their row borders: (word slots, woff, slots of three code points, goff)."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    ends = np.append(starts, len(data))
    coff = np.searchsorted(starts, offs)
    n = np.maximum(np.diff(coff) - 2, 0)
    goff = np.concatenate(([0], np.cumsum(n)))
    at = np.arange(goff[-1]) + np.repeat(coff[:-1] - goff[:-1], n)
    h = (prefix[ends[at + 3]] - prefix[starts[at]]) * K.FIRST.back[starts[at]]
    h = (h ^ (h >> K.U64(29))) * K.U64(0x9E3779B97F4A7C15)
    return (wh >> K.U64(64 - BITS)).astype(np.int64), woff, (h >> K.U64(64 - BITS)).astype(np.int64), goff


def _repeats(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(again, shared): positions equal to an earlier one of their row; positions with any equal one."""
    key = K.mix(h + row.astype(np.uint64) * K.U64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(h), bool)
    again[order[1:][same]] = True
    shared = again.copy()
    shared[order[:-1][same]] = True
    return again, shared


def _measure(data: np.ndarray, offs: np.ndarray):
    """The five counts of each row, and the prefix sums and word hashes for the model."""
    s, e, woff = K.words(data, offs)
    first, second = K.FIRST.prefix(data), K.SECOND.prefix(data)
    wh = K.FIRST.ranges(first, s, e)
    nw = np.diff(woff)
    chars = (~K.SPACE[data]) & ((data & 0xC0) != 0x80)
    ls, le, loff = K.lines(data, offs)
    line_row = np.repeat(np.arange(len(nw)), np.diff(loff))
    has_word = np.searchsorted(s, le) > np.searchsorted(s, ls)
    ls, le, line_row = ls[has_word], le[has_word], line_row[has_word]
    again, _ = _repeats(K.FIRST.ranges(first, ls, le) ^ K.SECOND.ranges(second, ls, le) * K.U64(3), line_row)
    dup_lines = np.bincount(line_row[again], minlength=len(nw))

    per = np.maximum(nw - WINDOW + 1, 0)
    row = np.repeat(np.arange(len(nw)), per)
    at = woff[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    _, shared = _repeats(K.combine(wh, WINDOW, at), row)
    cover = np.zeros(len(s) + 1, np.int64)
    np.add.at(cover, at[shared], 1)
    np.add.at(cover, at[shared] + WINDOW, -1)
    repeat = _row_sums(np.cumsum(cover)[:-1] > 0, woff)
    counts = dict(zip(_COUNTS, (nw, _row_sums(chars, offs), _row_sums(_SYMBOL[data], offs), dup_lines, repeat)))
    return counts, first, wh, woff


def _margin(model: Model, data, offs, prefix, wh, woff) -> np.ndarray:
    w, wo, g, go = _slots(data, offs, prefix, wh, woff)
    out = np.full(len(offs) - 1, model.intercept)
    for slots, at, weights in ((w, wo, model.weights[:DIMS]), (g, go, model.weights[DIMS:])):
        out += SHARE * _row_sums(weights[slots], at) / np.maximum(np.diff(at), 1)
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label, held flag and features of each row, a sparse vector as MLlib stores it."""
    for batch in batches:
        for rows, data, offs in K.text_chunks(batch):
            s, e, woff = K.words(data, offs)
            prefix = K.FIRST.prefix(data)
            w, wo, g, go = _slots(data, offs, prefix, K.FIRST.ranges(prefix, s, e), woff)
            slots, values = [], []
            for i in range(rows.num_rows):
                parts = [np.unique(x[o[i]:o[i + 1]] + base, return_counts=True) for x, o, base in ((w, wo, 0), (g, go, DIMS))]
                slots.append(np.concatenate([p[0] for p in parts]).astype(np.int32))
                values.append(np.concatenate([SHARE * p[1] / max(p[1].sum(), 1) for p in parts]))
            n = rows.num_rows
            vector = pa.StructArray.from_arrays([pa.array([0] * n, pa.int8()), pa.array([2 * DIMS] * n, pa.int32()), pa.array(slots, pa.list_(pa.int32())),
                                                 pa.array(values, pa.list_(pa.float64()))], ["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([K.column(rows, "label"), K.column(rows, "held"), vector], ["label", "held", "features"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_rows: int = 6000) -> Model | None:
    """Fit and calibrate on at most ``max_rows`` labelled documents; None without both classes.

    The sample's features are written once and read in ``FIT_PARTS`` partitions, however many the documents
    have, so an iteration is a few tasks and sums as many gradients. They are read back as MLlib's vectors:
    one Python worker a task, none that holds MLlib's modules, and none while fitting.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.linalg import VectorUDT

    chosen = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("label"))
              .where("id is not null and label in (0, 1)").distinct()
              .orderBy(F.xxhash64("id"), "id", "label").limit(max_rows))
    texts = ready(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id")  # at most max_rows small rows
    held = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(5)) == 0
    fields = [T.StructField("label", T.DoubleType()), T.StructField("held", T.BooleanType())]
    stored = T.StructType([*fields, T.StructField("features", VectorUDT.sqlType())])
    path = scratch_path(docs.sparkSession, "features")
    rows.select("label", held.alias("held"), "text").mapInArrow(_features, stored).write.mode("overwrite").parquet(path)
    vectors = T.StructType([*fields, T.StructField("features", VectorUDT())])
    data = docs.sparkSession.read.schema(vectors).parquet(path).coalesce(FIT_PARTS).persist()
    try:
        if data.where("not held").select("label").distinct().count() < 2:
            return None
        lr = LogisticRegression(maxIter=60, regParam=1e-4, standardization=False).fit(data.where("not held"))
        margins = lr.transform(data.where("held")).select(
            "label", array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("features")).persist()
        scale, shift = 1.0, 0.0
        if margins.select("label").distinct().count() == 2:
            platt = LogisticRegression(maxIter=50, regParam=1e-3, standardization=False).fit(margins)
            scale, shift = float(platt.coefficients[0]), float(platt.intercept)
        margins.unpersist()
    finally:
        data.unpersist()
    return Model(np.asarray(lr.coefficients.toArray()), float(lr.intercept), scale, shift)


def apply_rules(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
                keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per document: the id, the five counts, base_failed, probability and kept."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 2 * DIMS doubles

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for rows, data, offs in K.text_chunks(batch):
                c, prefix, wh, woff = _measure(data, offs)
                failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PCT * c["n_words"])
                if m is None:
                    p, good = pa.nulls(rows.num_rows, pa.float64()), ~failed
                else:
                    prob = m.probability(_margin(m, data, offs, prefix, wh, woff))
                    p, good = pa.array(prob), ~failed & (prob >= keep_from)
                yield pa.RecordBatch.from_arrays(
                    [K.column(rows, "id"), *(pa.array(c[k].astype(np.int64)) for k in _COUNTS),
                     pa.array(failed), p, pa.array(good)], names)

    names = ["id", *_COUNTS, "base_failed", "probability", "kept"]
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType)]
                          + [T.StructField(k, T.LongType()) for k in _COUNTS]
                          + [T.StructField("base_failed", T.BooleanType()), T.StructField("probability", T.DoubleType()),
                             T.StructField("kept", T.BooleanType())])
    src = ready(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(score, schema).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: Model | None, text_col: str = "text",
              keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs``, all columns, that pass rules and model; decided row by row, so repeated or null ids are safe."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for rows, data, offs in K.text_chunks(batch, text_col):
                c, prefix, wh, woff = _measure(data, offs)
                good = (c["n_words"] >= MIN_WORDS) & (100 * c["n_repeat_words"] <= MAX_REPEAT_PCT * c["n_words"])
                if m is not None:
                    good &= m.probability(_margin(m, data, offs, prefix, wh, woff)) >= keep_from
                if good.any():
                    yield rows.filter(pa.array(good))

    return ready(docs).mapInArrow(select, docs.schema)
