"""From the clean long table to documents and a keyword index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetlake.functions import fixed, tokens
from sheetlake.operators.bm25 import KeywordIndex, build_index
from sheetlake.operators.corpus import build_document_parts, chunk_docs, tokenize_docs
from sheetlake.operators.sizes import spread_texts
from sheetlake.sources import files, sinks


def index_documents(
    docs: DataFrame,
    max_bytes: int = fixed.CHUNK_BYTES,
    tokenizer=tokens.words,
    vocabulary: DataFrame | None = None,
    small: bool | None = None,
) -> KeywordIndex:
    """Tokenise, chunk and index documents ``(id, contents)``; lazy.

    One shuffle places the documents by id; tokens, chunks, term counts and the
    scores of a later search are all made where the document lies.
    """
    placed = spread_texts(docs.select("id", "contents"), "id", "contents")
    chunks = chunk_docs(tokenize_docs(placed, tokenizer), max_bytes)
    return build_index(chunks, tokens.spaced, vocabulary, small)


def build_search_index(
    spark: SparkSession, clean: DataFrame, folder: str, max_bytes: int = fixed.CHUNK_BYTES
) -> KeywordIndex:
    """Write documents, chunks and index tables below a folder.

    Records longer than ``max_bytes`` are written in parts, so that none is ever one row, and a pair
    longer than that is cut with the chunks.  Finished documents and chunks of the same rows
    and settings are kept; anything else that is there is replaced.
    """
    made_of = sinks.fingerprint(clean, max_bytes)
    sinks.save_documents(build_document_parts(clean, max_bytes), f"{folder}/documents", made_of)
    docs = files.read_documents(spark, f"{folder}/documents")
    sinks.save_documents(chunk_docs(tokenize_docs(docs), max_bytes), f"{folder}/chunks", made_of)
    chunks = files.read_documents(spark, f"{folder}/chunks")
    build_index(chunks, tokens.spaced).save(f"{folder}/keyword_index")
    return KeywordIndex.load(spark, f"{folder}/keyword_index")
