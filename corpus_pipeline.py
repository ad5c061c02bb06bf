"""The corpus pipeline: toxicity, exact copies, near copies, repeated passages, packing.

Each stage gets what its predecessor kept, decides on all of it, and returns the
columns of ``documents``; the last one returns the packed pieces.  A stage's
result is written as Parquet and read back before the next one starts.

Stage by stage: documents predicted to be toxic go; of equal texts (A-Z in
lower case) the largest ``doc_id`` stays; of near copies (five-word shingles, similarity
0.8 or more) the smallest ``doc_id`` stays; repeated passages are cut from all documents but the
first; what is left is packed.  Null texts count as empty.  Every row is judged by its own text, also where several have one ``doc_id``; rows
without a ``doc_id`` are never near copies of others.  Other columns, whatever their
names, pass through the filtering stages untouched.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetlake.llm import chosenpath, packing, recipes, spans, toxicity
from sheetlake.llm.queries import WORD_BPE, table
from sheetlake.session import written

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents predicted to be toxic by their nearest labelled examples."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of each group of equal texts."""
    return recipes.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of each group of near copies."""
    return chosenpath.drop_near_copies(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages; ``n_chars`` follows the text where it is cut."""
    count = spans.free_name(docs.columns, "n_removed")
    cleaned = spans.without_repeats(docs, count)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col(count) > 0, length).otherwise(F.col("n_chars")))
    return cleaned.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return packing.packed_sequences(docs, WORD_BPE)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack),
]

#: Toxicity is learned and packing is a search, which SQL can't express; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return stage_result(spark, docs, sf_dir)


def stage_result(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage, written and read back like the others."""
    name, stage = STAGES[-1]
    return written(stage(spark, docs, sf_dir), name)
