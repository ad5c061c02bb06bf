"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null without an id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def sample_labels(labels: DataFrame, column: str, rows: int) -> DataFrame:
    """(doc_id, label) of at most ``rows`` documents with one distinct, non-null label, chosen by a hash of the id."""
    one = (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(column).alias("label"), F.max(column).alias("_other"))
        .where("label = _other")
        .drop("_other")
    )
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def sample_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label) of sampled documents.  The sample is bounded, so it is sent to every task."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(sample), "doc_id")


def one_text_each(sample: DataFrame) -> DataFrame:
    """(doc_id, text, label) with one row per id, whatever rows repeat it: the text with the least hash."""
    return sample.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.min("label").cast("int").alias("label"))
