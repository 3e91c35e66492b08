"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.tables import load_table

from . import bpe_chunks, exact_dedup, filter_audit, html_extract, jaccard_join, line_dedup, lm_scoring, packing, pieces, quality, ranked_search
from . import sharding, substring_dedup
from .common import small_batches


def op1_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(load_table(small_batches(spark), sf, "documents", ["doc_id", "text"]), 40)


def op2_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    pages = load_table(small_batches(spark), sf, "pages", ["page_id", "url", "html"])
    return html_extract.extract(pages, html_extract.fit(pages))


def op3_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """All ``documents`` and all turns of ``conversations``: the vocabulary's own ids (BPE merges), the Viterbi ids, and the decoded text."""
    docs = load_table(small_batches(spark), sf, "documents", ["doc_id", "text"])
    turns = load_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    table = pieces.piece_table(spark, piece_model())
    both = pieces.encode_all(docs.unionByName(turns, allowMissingColumns=True), table, {"ids": "bpe", "viterbi_ids": "viterbi"})
    return pieces.decode(both, table).select("doc_id", "conv_id", "turn", "ids", "viterbi_ids", F.size("ids").alias("n_ids"),
                                             F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"))


def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = load_table(small_batches(spark), sf, "documents", ["doc_id", "text"])
    return packing.pack(docs, *byte_bpe())


def op5_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.join(load_table(small_batches(spark), sf, "documents", ["doc_id", "text"]))


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.dedup(load_table(small_batches(spark), sf, "documents", ["doc_id", "text"]))


def op7_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.dedup(load_table(small_batches(spark), sf, "documents", ["doc_id", "text"]), inside=True)


def op8_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return lm_scoring.score(load_table(small_batches(spark), sf, "documents", ["doc_id", "text"]))


def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.dedup(load_table(small_batches(spark), sf, "documents", ["doc_id", "text"]))


def piece_model() -> str:
    """File of the public SentencePiece vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_bpe() -> tuple[str, str]:
    """File and pre-tokenizer pattern of the public byte-level BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = load_table(small_batches(spark), sf, "documents", ["doc_id", "text"])
    model = quality.fit(docs, load_table(small_batches(spark), sf, "labels", ["doc_id", "quality"]))
    return quality.apply_rules(docs, model)


def op11_filter_interaction_audit(spark: SparkSession, sf: str) -> DataFrame:
    docs = load_table(spark, sf, "documents", ["doc_id", "text", "lang"])
    return filter_audit.audit_documents(docs, load_table(spark, sf, "labels", ["doc_id", "quality", "toxic"]))


def op12_ranked_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    docs = load_table(small_batches(spark), sf, "documents", ["doc_id", "text"])
    return ranked_search.search_documents(docs, load_table(spark, sf, "benchmark", ["item_id", "text"]), 50)


def op13_bpe_encoding(spark: SparkSession, sf: str) -> DataFrame:
    docs = load_table(small_batches(spark), sf, "documents", ["doc_id", "text"])
    path, pattern = byte_bpe()
    both = bpe_chunks.decode(bpe_chunks.encode(docs, path, pattern), path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_html_extraction": op2_html_extraction,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_packing": op4_packing,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_filter_interaction_audit": op11_filter_interaction_audit,
    "op12_ranked_lexical_search": op12_ranked_lexical_search,
    "op13_bpe_encoding": op13_bpe_encoding,
}
