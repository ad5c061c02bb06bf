"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetlake.llm import (
    chosenpath,
    hardnegatives,
    language,
    packing,
    prefixtrie,
    quality,
    quotes,
    rankcoder,
    recipes,
    spans,
    tokencounts,
    toxicity,
    wavelet,
)

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = str(public_tokenizers.path("byte_bpe_50k.json"))
BYTE_BPE_SIZE = 50_257
MULTI_RANKS = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
WORD_BPE = str(public_tokenizers.path("word_bpe_49k.json"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_wavelet_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return wavelet.shard_tokens_digests(docs, BYTE_BPE, BYTE_BPE_SIZE)


def op2_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return chosenpath.near_duplicates(table(spark, folder, "documents"), size=2, percent=80)


def op3_certified_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_sequences(table(spark, folder, "documents"), WORD_BPE)


def op4_rank_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(table(spark, folder, "documents"))


def op5_nearest_examples(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_hashed_regression(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cleaned = spans.without_repeats(docs)
    return cleaned.select("doc_id", "text", "n_removed", (F.col("n_removed") > 0).alias("had_repeats"))


def op8_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    return recipes.exact_groups(table(spark, folder, "documents"))


def op9_stitched_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return rankcoder.encoded_digests(table(spark, folder, "documents"), MULTI_RANKS, public_tokenizers.PATTERN)


def op10_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.conversations(table(spark, folder, "conversations"))


def op11_coordinate_pruning(spark: SparkSession, folder: str) -> DataFrame:
    return hardnegatives.hard_negatives(table(spark, folder, "embeddings"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, folder, "conversations"))


def op13_digest_cache(spark: SparkSession, folder: str) -> DataFrame:
    return tokencounts.token_counts(table(spark, folder, "documents"), BYTE_BPE)


QUERIES = (
    op1_wavelet_shards,
    op2_chosen_path,
    op3_certified_packing,
    op4_rank_profiles,
    op5_nearest_examples,
    op6_hashed_regression,
    op7_sentence_spans,
    op8_chunk_recipes,
    op9_stitched_chunks,
    op10_quotation_linking,
    op11_coordinate_pruning,
    op12_prefix_trie,
    op13_digest_cache,
)


def all_queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}
