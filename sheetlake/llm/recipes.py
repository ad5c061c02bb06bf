"""Exact duplicates by content-defined chunk recipes, with DataFrame functions only.

A text is cut where its content says so (behind the first sentence or line end
after ``SHORTEST`` characters, at ``LONGEST`` characters where there is none), so equal
texts have equal chunks.  Each distinct chunk travels once per task to be
checked: a 64-bit identifier is verified when exactly one chunk text has it.
Documents are then compared by their ordered identifier lists, eight bytes a
chunk; the texts themselves stay where they are.  A document that holds an
identifier shared by two different chunks is compared by its whole text as well.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from sheetlake.session import written

SHORTEST = 1024
LONGEST = 8192
SALTS = 32

CHUNK = rf"(?s).{{{SHORTEST},{LONGEST}}}?(?<=[.!?\n])|.{{{LONGEST}}}|.+"


def normalised(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; null is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), ascii_uppercase, ascii_lowercase)


def chunks(text: Column) -> Column:
    """The content-defined chunks of a text, in order; together they are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def recipes(docs: DataFrame, identify: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, text_sha256, recipe, whole): what two documents are compared by.

    ``recipe`` is the ordered identifier list.  ``whole`` is null, or the text of
    a document that holds an unverified identifier.  ``identify`` maps a chunk to a long.
    """
    texts = docs.select("doc_id", normalised(F.col("text")).alias("_text"))
    cut = texts.select("doc_id", F.explode(chunks(F.col("_text"))).alias("_chunk"))
    shared = (
        cut.groupBy("_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(identify(F.col("_chunk")).alias("_id"))
        .agg(F.count(F.lit(1)).alias("_texts"))
        .where("_texts > 1")
        .select("_id")
    )
    shared = written(shared, "shared")
    listed = written(
        texts.select(
            "doc_id",
            F.sha2(F.col("_text"), 256).alias("text_sha256"),
            F.transform(chunks(F.col("_text")), lambda x: identify(x)).alias("recipe"),
        ),
        "recipes",
    )
    if shared.isEmpty():
        return listed.withColumn("whole", F.lit(None).cast("string"))
    held = listed.select("text_sha256", F.explode(F.array_distinct("recipe")).alias("_id"))
    unverified = held.join(shared, "_id").select("text_sha256").distinct()
    whole = (
        texts.withColumn("text_sha256", F.sha2(F.col("_text"), 256))
        .join(unverified, "text_sha256", "left_semi")
        .select("text_sha256", F.col("_text").alias("whole"))
        .distinct()
    )
    return listed.join(whole, "text_sha256", "left").select("doc_id", "text_sha256", "recipe", "whole")


def exact_groups(docs: DataFrame, identify: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs(doc_id, text)``.

    Equal texts (after lower-casing A-Z; null counts as empty) form a group, of
    which the row with the largest ``doc_id`` stays.  A null ``doc_id`` stays only
    where its group has no other; rows that repeat both id and text are the same
    document and share its verdict.  An empty table gives no rows; other columns
    are ignored.  A hot group is counted in ``SALTS`` parts, and joined back by
    part, so none of its rows meet in one task.
    """
    keyed = written(
        recipes(docs, identify).withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")), "keyed"
    )
    parts = keyed.groupBy("recipe", "whole", "_salt").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    groups = (
        parts.groupBy("recipe", "whole")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), F.collect_list("_salt").alias("_salts"))
        .select("recipe", "whole", "keep_id", "group_size", F.explode("_salts").alias("_salt"))
    )
    same = keyed["whole"].eqNullSafe(groups["whole"])
    return keyed.join(
        groups, (keyed["recipe"] == groups["recipe"]) & (keyed["_salt"] == groups["_salt"]) & same
    ).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns.

    Where several rows have the ``doc_id`` that stays and an equal text, one of them
    stays.  Rows are only dealt by document for that if there are any.
    """
    kept = exact_groups(docs).where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("_n"))
    stay = written(kept.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), "_n"), "stay")
    sha = F.sha2(normalised(docs["text"]), 256)
    found = docs.join(stay, docs["doc_id"].eqNullSafe(stay["_id"]) & (sha == stay["_sha"]), "left_semi")
    if stay.where("_n > 1").isEmpty():
        return found
    name = "_sha"
    while name in {x.lower() for x in docs.columns}:
        name = f"_{name}"
    keyed = found.withColumn(name, F.sha2(normalised(F.col("text")), 256))
    return keyed.dropDuplicates(["doc_id", name]).select(docs.columns)
