"""Search documents: assembly, tokens, chunks and spot checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetlake.functions import fixed, tokens
from sheetlake.functions.text import preview, strip
from sheetlake.operators.ordered import running_total
from sheetlake.operators.sizes import is_small
from sheetlake.session import written


# Bytes of the longest character in UTF-8.
LONGEST_CHARACTER = 4


def document_pairs(clean: DataFrame) -> DataFrame:
    """``(id, original_column_name, value, text)`` with text ``detail: value``."""
    text = F.concat("detail", F.lit(fixed.NAME_VALUE_SEPARATOR), "value")
    return clean.select(
        F.concat("year", F.lit("-"), "business_id").alias("id"),
        "original_column_name",
        "value",
        text.alias("text"),
    )


def _assemble(pairs: DataFrame, keys: Sequence[str], separator: str) -> DataFrame:
    """Texts of each group in order of column name and value.

    Rows are brought together once and collected there, so no half-built lists
    are shuffled.
    """
    entry = F.when(F.col("text").isNotNull(), F.struct("original_column_name", "value", "text"))
    ordered = F.array_sort(F.collect_list(entry))
    return (
        pairs.repartition(*keys)
        .groupBy(*keys)
        .agg(F.array_join(ordered["text"], separator).alias("contents"))
    )


def build_documents(clean: DataFrame, separator: str = fixed.PAIR_SEPARATOR) -> DataFrame:
    """One document ``(id, contents)`` per year and business id.

    A document is one row and is put together in one task.  Where a record may
    be too long for that, ``build_document_parts`` makes the same texts in
    pieces.
    """
    return _assemble(document_pairs(clean), ["id"], separator)


def build_document_parts(
    clean: DataFrame, max_bytes: int = fixed.CHUNK_BYTES, separator: str = fixed.PAIR_SEPARATOR
) -> DataFrame:
    """Documents, those beyond ``max_bytes`` as parts that are never held whole.

    ``(id, parent_id, contents)``: a part holds the pairs that start inside its
    stretch of ``max_bytes`` bytes and is named like a chunk, so parts can be
    indexed in place of chunks.  One record may hold any share of all rows.
    """
    size = F.coalesce(F.octet_length("text") + len(separator.encode()), F.lit(0))
    # A record without an id is a record like any other: no id is empty text.
    pairs = document_pairs(clean).withColumn("id", F.coalesce("id", F.lit("")))
    sizes = pairs.groupBy("id").agg(F.sum(size).alias("bytes"))
    long_ids = written(sizes.filter(F.col("bytes") > max_bytes).select("id"), "long-ids")
    if is_small(long_ids):
        long_ids = F.broadcast(long_ids)
    whole = _assemble(pairs.join(long_ids, "id", "left_anti"), ["id"], separator)

    placed = running_total(pairs.join(long_ids, "id", "left_semi"), ["id"], ["original_column_name", "value"], size, "end")
    start = F.col("end") - size
    numbered = placed.withColumn("part_no", F.floor(start / max_bytes))
    # A stretch that holds nothing but null pairs is no part; a pair that fills several leaves no gap.
    parts = written(_assemble(numbered, ["id", "part_no"], separator).filter(F.col("contents") != ""), "parts")
    in_order = Window.partitionBy("id").orderBy("part_no")
    dense = parts.select("id", "part_no").withColumn("_no", F.row_number().over(in_order) - 1)
    parts = parts.join(dense, ["id", "part_no"])
    name = F.concat("id", F.lit(fixed.CHUNK_MARK), F.col("_no").cast("string"))
    parent = F.nullif("id", F.lit("")).alias("parent_id")
    return whole.select(F.nullif("id", F.lit("")).alias("id"), parent, "contents").unionAll(
        parts.select(name.alias("id"), parent, "contents")
    )


def tokenize_docs(
    docs: DataFrame, tokenizer: Callable[[Column], Column] = tokens.words
) -> DataFrame:
    """Documents with their tokens joined by one space."""
    return docs.withColumn("contents", F.array_join(tokenizer(F.col("contents")), " "))


def chunk_docs(docs: DataFrame, max_bytes: int = fixed.CHUNK_BYTES) -> DataFrame:
    """Cut documents longer than ``max_bytes`` UTF-8 bytes at spaces.

    Longer documents become chunks ``<id>_chunk_<n>``; each chunk takes as much
    as fits and ends before the last space inside the budget.  A token longer
    than the budget is cut between characters.  Others pass unchanged.

    The text is viewed as one character per byte, which lets one regular
    expression count bytes; everything stays inside the JVM.
    """
    if max_bytes < LONGEST_CHARACTER:
        raise ValueError(f"a chunk must hold a character: at least {LONGEST_CHARACTER} bytes")
    long = F.octet_length("contents") > max_bytes
    as_bytes = F.decode(F.encode(F.when(long, F.col("contents")), "UTF-8"), "ISO-8859-1")
    rest = rf"[\x00-\xFF]{{1,{max_bytes}}}\z"
    at_space = rf"[\x00-\xFF]{{1,{max_bytes - 1}}}(?= )"
    inside = rf"[\x00-\xFF]{{1,{max_bytes}}}(?![\x80-\xBF])"
    pieces = F.regexp_extract_all(as_bytes, F.lit(f"{rest}|{at_space}|{inside}"), F.lit(0))
    texts = F.transform(pieces, lambda p: F.decode(F.encode(p, "ISO-8859-1"), "UTF-8"))
    parts = F.when(long, texts).otherwise(F.array("contents"))
    cut = docs.select("id", long.alias("_long"), F.posexplode(parts).alias("chunk_no", "part"))
    mark = F.concat("id", F.lit(fixed.CHUNK_MARK), F.col("chunk_no").cast("string"))
    return cut.select(
        F.when(F.col("_long"), mark).otherwise(F.col("id")).alias("id"),
        F.col("id").alias("parent_id"),
        F.when(F.col("_long"), F.col("chunk_no")).alias("chunk_no"),
        F.when(F.col("_long"), strip(F.col("part"))).otherwise(F.col("part")).alias("contents"),
    )


def doc_preview(docs: DataFrame, chars: int = fixed.PREVIEW_CHARS) -> DataFrame:
    return docs.select("id", preview(F.col("contents"), chars).alias("preview"))


def corpus_check(
    docs: DataFrame,
    n: int = 3,
    order: Sequence[str] = ("id",),
    seed: int = 0,
    kinds: Sequence[str] = ("first", "last", "random"),
) -> DataFrame:
    """Document count with the first, last and n random documents.

    The random order is a hash of seed and id, so a sample can be repeated.  It
    is empty when the corpus has no more than n documents.
    """
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")))
    orders = {
        "first": [F.asc(c) for c in order],
        "last": [F.desc(c) for c in order],
        "random": [shuffled, *[F.asc(c) for c in order]],
    }
    total = docs.agg(F.count("*").alias("total_docs"))
    samples = [
        docs.orderBy(*orders[kind])
        .limit(n)
        .select(F.lit(kind).alias("sample_kind"), "id", preview(F.col("contents")).alias("preview"))
        for kind in kinds
    ]
    union = samples[0]
    for sample in samples[1:]:
        union = union.unionAll(sample)
    counted = union.withColumn("total_docs", total.scalar())
    return counted.filter((F.col("sample_kind") != "random") | (F.col("total_docs") > n))
