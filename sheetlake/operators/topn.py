"""The first n rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_n(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    spread: int = 64,
) -> DataFrame:
    """Rows ranked 1..n in each group, with their rank.

    Exact in two steps: each group is cut into ``spread`` hash slices and only
    the first n rows of a slice reach the final ranking, so a hot group is
    ranked by many tasks and the last task sees at most ``spread * n`` rows.
    """
    slice_no = F.pmod(F.xxhash64(*frame.columns), F.lit(spread))
    sliced = Window.partitionBy(*keys, "_slice").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    pruned = (
        frame.withColumn("_slice", slice_no)
        .withColumn("_rank", F.row_number().over(sliced))
        .filter(F.col("_rank") <= n)
        .drop("_slice", "_rank")
    )
    return pruned.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n)
