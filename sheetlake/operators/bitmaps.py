"""Which name occurs in which source, as bitmaps: any number of sources, counts and overlaps by bit operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetlake.operators.ordered import running_total
from sheetlake.session import written


def numbered(values: DataFrame, name: str) -> DataFrame:
    """The distinct values of the single column ``name`` with dense numbers from 0 (``no``), in their order; written."""
    distinct = values.select(name).where(F.col(name).isNotNull()).distinct()
    return written(running_total(distinct, [], [name], F.lit(1), "no").select(name, (F.col("no") - 1).alias("no")), "numbers")


def _bits(rows: DataFrame, key: str, no: Column) -> DataFrame:
    """(key, bucket, bits): one bitmap per key and bucket of numbers, combined before the shuffle."""
    return rows.groupBy(key, F.bitmap_bucket_number(no).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(no)).alias("bits")
    )


def presence_bitmaps(headers: DataFrame, sources: DataFrame) -> DataFrame:
    """(name, bucket, bits): in which of ``sources(source, no)`` each name of ``headers(source, name)`` occurs."""
    return _bits(headers.join(sources, "source"), "name", F.col("no"))


def bitmap_presence_count(bitmaps: DataFrame) -> DataFrame:
    """In how many sources each name occurs; twin of ``presence_count``."""
    return bitmaps.groupBy("name").agg(F.sum(F.bitmap_count("bits")).alias("presence_count"))


def in_all(bitmaps: DataFrame, names: list[str]) -> DataFrame:
    """(bucket, bits): the sources that have all of some names."""
    wanted = list(dict.fromkeys(names))
    return (
        bitmaps.where(F.col("name").isin(wanted))
        .groupBy("bucket")
        .agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == len(wanted))
        .select("bucket", "bits")
    )


def count_in_all(bitmaps: DataFrame, names: list[str]) -> int:
    """In how many sources all of some names occur; one number reaches the driver."""
    return in_all(bitmaps, names).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0))).head()[0]


def source_overlap(headers: DataFrame, pairs: DataFrame) -> DataFrame:
    """(source_a, source_b, shared_names): the number of names that both sources of each asked pair have.

    A source is a few bitmaps over the numbered names, however many columns it has, and a pair
    meets bucket by bucket; pairs without a common bucket share 0.  ``pairs`` is ``(source_a, source_b)``.
    """
    # Each name of a source once: however often it occurs, one row is joined.
    once = written(headers.select("source", "name").where("source is not null and name is not null").distinct(), "source-names")
    held = written(_bits(once.join(numbered(once, "name"), "name"), "source", F.col("no")), "source-bits")
    asked = pairs.select("source_a", "source_b").distinct()
    both = asked.withColumn("source", F.explode(F.array("source_a", "source_b"))).join(held, "source")
    met = (
        both.groupBy("source_a", "source_b", "bucket")
        .agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
        .where("n = 2")
        .groupBy("source_a", "source_b")
        .agg(F.sum(F.bitmap_count("bits")).alias("shared_names"))
    )
    return asked.join(met, ["source_a", "source_b"], "left").na.fill(0, ["shared_names"])
