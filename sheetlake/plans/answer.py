"""From questions to prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sheetlake.functions import fixed, tokens
from sheetlake.operators.bm25 import KeywordIndex, bm25_search, build_query_index, query_terms
from sheetlake.operators.corpus import chunk_docs, tokenize_docs
from sheetlake.operators.hybrid import assemble_prompt, few_hits, hybrid_search
from sheetlake.operators.sizes import is_small
from sheetlake.operators.vectors import knn_l2
from sheetlake.session import written


def search(
    index: KeywordIndex,
    vectors: DataFrame,
    docs: DataFrame,
    queries: DataFrame,
    k: int = fixed.TOP_K,
    tokenizer=tokens.words,
) -> DataFrame:
    """Merged hits of a batch of queries ``(query_id, text, embedding)``."""
    keyword = bm25_search(index, queries, k, tokenizer=tokenizer)
    return hybrid_search(keyword, knn_l2(vectors, queries, k), docs, few_hits(queries, k))


def search_documents(
    docs: DataFrame,
    queries: DataFrame,
    k: int = fixed.TOP_K,
    max_bytes: int = fixed.CHUNK_BYTES,
    tokenizer=tokens.words,
) -> DataFrame:
    """Keyword hits straight from documents: only the query terms are indexed."""
    terms = written(query_terms(queries, tokenizer), "terms")
    small = is_small(terms)
    chunks = chunk_docs(tokenize_docs(docs.select("id", "contents"), tokenizer), max_bytes)
    index = build_query_index(chunks, terms, tokens.spaced, small)
    return bm25_search(index, queries, k, tokenizer=tokenizer, small=small)


def prompts(
    index: KeywordIndex, vectors: DataFrame, docs: DataFrame, queries: DataFrame, k: int = fixed.TOP_K
) -> DataFrame:
    """One prompt per query."""
    return assemble_prompt(queries, search(index, vectors, docs, queries, k))
