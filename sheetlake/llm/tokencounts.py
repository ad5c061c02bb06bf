"""Token counts of whole texts from a cache of digests.

A count depends on the content and on the tokenizer, so a cache entry is named by a
digest of each: the folder by that of the tokenizer's file and the library's
version, the row by SHA-256 of the text.  A run joins the digests of its texts to the
stored counts, encodes one text of each digest that is missing, and appends what it found;
every row then takes its count from the cache.  A null text is normalised to an empty
one; nothing else about a text may change without changing its count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from importlib.metadata import version
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetlake.llm.encode import encoder
from sheetlake.llm.scratch import Scratch
from sheetlake.llm.ship import ship
from sheetlake.session import remove_at_end, scratch_path, written

LIMIT = 1024
SALTS = 32

CACHED = "digest binary, n_tokens long"


def tokenizer_version(tokenizer: str) -> str:
    """A digest of the tokenizer's file and of the library that reads it."""
    return hashlib.sha256(Path(tokenizer).read_bytes() + version("tokenizers").encode()).hexdigest()


def content(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def digest(text: Column) -> Column:
    """32 bytes that name a text."""
    return F.unhex(F.sha2(text, 256))


def stored_counts(spark: SparkSession, folder: str) -> DataFrame | None:
    """(digest, n_tokens), one row per digest whatever runs have appended; None without a cache."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(CACHED).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _counter(tokenizer: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            counts = pa.array(encode.all_counts(batch.column(1)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts], ["digest", "n_tokens"])

    return count


def fill_cache(docs: DataFrame, digests: DataFrame, tokenizer: str, cache: str) -> str:
    """Encode one text of each digest that the cache lacks and append its count; the folder of this tokenizer.

    Copies are combined before the shuffle, and once there is a cache only texts it lacks are shuffled.
    """
    spark = docs.sparkSession
    folder = f"{cache}/{tokenizer_version(tokenizer)}"
    texts = docs.select(content(F.col("text")).alias("text")).select(digest(F.col("text")).alias("digest"), "text")
    known = stored_counts(spark, folder)
    with Scratch(spark) as scratch:
        if known is not None:
            missing = digests.select("digest").distinct().join(known, "digest", "left_anti")
            texts = texts.join(scratch.written(missing, "misses"), "digest", "left_semi")
        counted = texts.dropDuplicates(["digest"]).mapInArrow(_counter(tokenizer), CACHED)
        counted.write.mode("append").parquet(folder)
    return folder


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs(doc_id, text)``.

    ``cache`` is a folder all executors share; without one the counts are kept for this
    call only.  A null or empty text has no bytes and no tokens.  Null and repeated
    ids are rows like any other; other columns are ignored; an empty table gives no rows.
    A digest that a third of all rows share is joined back in ``SALTS`` parts.
    """
    spark = docs.sparkSession
    ship(spark)
    text = content(F.col("text"))
    keyed = written(
        docs.select(
            F.col("doc_id").cast("long"),
            F.octet_length(text).cast("long").alias("n_bytes"),
            digest(text).alias("digest"),
            F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("_salt"),
        ),
        "digests",
    )
    own = cache is None
    cache = cache or scratch_path(spark, "token-counts")
    folder = fill_cache(docs, keyed, tokenizer, cache)
    if own:
        remove_at_end(spark, cache)
    cells = keyed.groupBy("digest", "_salt").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    counts = cells.join(stored_counts(spark, folder), "digest")
    return keyed.join(counts, ["digest", "_salt"]).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
