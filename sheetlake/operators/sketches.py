"""Stored sketches of the distinct values of every column, to which new files are added without reading old ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Sketch buckets as a power of two; with 2**14 the standard error of an estimate is below one percent.
LG_BUCKETS = 14
#: Three standard errors: what an estimate may be off, but for one in some hundred columns.
ERROR = 0.03

COLUMN = ("source", "pos", "name")


def column_sketches(column_cells: DataFrame, lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """(source, pos, name, n_filled, sketch) of ``cells(source, pos, name, value)``; null values are not counted.

    Sketches are made on the map side and merged, so a hot column moves a few kilobytes per task.
    A column of nulls only has no sketch.
    """
    return column_cells.groupBy(*COLUMN).agg(
        F.count("value").alias("n_filled"), F.hll_sketch_agg("value", F.lit(lg_buckets)).alias("sketch")
    )


def add_sketches(column_cells: DataFrame, path: str, lg_buckets: int = LG_BUCKETS) -> None:
    """Append the sketches of some more cells to a stored table."""
    column_sketches(column_cells, lg_buckets).write.mode("append").parquet(path)


def estimated_uniqueness(stored: DataFrame, keys: tuple[str, ...] = COLUMN) -> DataFrame:
    """Filled cells, estimated distinct values and their ratio per column, from stored sketches alone.

    With fewer keys (``("name",)``) columns are united over their sources.  Twin of ``column_uniqueness``, which is exact.
    """
    distinct = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0))
    merged = stored.groupBy(*keys).agg(F.sum("n_filled").alias("non_empty_count"), distinct.alias("n_distinct"))
    # An estimate may come out above the number of cells, which the true number can't.
    capped = merged.withColumn("n_distinct", F.least("n_distinct", "non_empty_count"))
    return capped.withColumn(
        "uniqueness", F.when(F.col("non_empty_count") > 0, F.col("n_distinct") / F.col("non_empty_count")).otherwise(0.0)
    )
