"""Corpus pipeline: quality rules, line dedup, near-duplicate join, substring dedup, packing.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a frame.
All but the last return the columns of ``docs``. Stages drop rows or cut text as their operator decides:

1. quality_rules drops documents that the rules or the calibrated model reject;
2. line_dedup cuts repeated lines, except in the smallest id that holds them;
3. ngram_jaccard_join leaves one document, the smallest id, of each near-duplicate component;
4. substring_dedup cuts repeated passages, except at their first place;
5. packing returns the pieces of all documents in sequences of at most 2048 tokens.

``run`` writes each stage as Parquet under the shared checkpoint folder and reads it back, so a lost
executor repeats one stage's tasks, and each stage is computed once. Null texts are rejected by stage 1;
where ``n_chars`` is a column it follows the text. An empty table passes through as an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import jaccard_join, line_dedup, packing, quality, substring_dedup
from quarry.llm.common import pin, small_batches
from quarry.llm.queries import byte_bpe
from quarry.sources.tables import load_table

ORACLE_SQL = None  # the model, the hash kernels and the packing are not SQL; see tests/llm/test_pipeline.py


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, load_table(small_batches(spark), sf_dir, "labels", ["doc_id", "quality"]))
    return quality.keep_good(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return _counted(line_dedup.dedup_texts(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard_join.representatives(docs)


def dedup_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return _counted(substring_dedup.dedup_texts(docs, inside=True))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs, *byte_bpe())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", one_of_each),
    ("substring_dedup", dedup_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir))
    return docs
