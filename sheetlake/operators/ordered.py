"""Running totals inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetlake.session import written


def laid_out(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows by range of key and order, written with the number of their ``_slice``, for any number of ``total_over``.

    A random tie-breaker spreads a hot group, or many equal rows, over many tasks.  The layout is
    written to the shared folder, since all uses must see the same slices.
    """
    return written(
        frame.withColumn("_tie", F.rand(0))
        .repartitionByRange(*keys, *order, "_tie")
        .withColumn("_slice", F.spark_partition_id()),
        "slices",
    )


def total_over(laid: DataFrame, keys: Sequence[str], order: Sequence[str], amount: Column, name: str) -> DataFrame:
    """Add the sum of ``amount`` over all rows of the group up to and with this one, to rows ``laid_out`` by key and order.

    Each slice is summed on its own and shifted by the totals of the slices before
    it; there are no more of those per group than there are tasks.
    """
    laid = laid.withColumn("_amount", amount.cast("long"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        laid.groupBy(*keys, "_slice")
        .agg(F.sum("_amount").alias("_sum"))
        .withColumn("_shift", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .drop("_sum")
    )
    inside = (
        Window.partitionBy(*keys, "_slice")
        .orderBy(*order, "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        laid.withColumn("_inside", F.sum("_amount").over(inside))
        .join(shifts, [*keys, "_slice"])
        .withColumn(name, F.col("_inside") + F.col("_shift"))
        .drop("_amount", "_inside", "_shift")
    )


def running_total(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], amount: Column, name: str = "total"
) -> DataFrame:
    """Add the sum of ``amount`` over all rows of the group up to and with this one, however large the group is."""
    laid = laid_out(frame.withColumn("_of", amount.cast("long")), keys, order)
    return total_over(laid, keys, order, F.col("_of"), name).drop("_of", "_tie", "_slice")
