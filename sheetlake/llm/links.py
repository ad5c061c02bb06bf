"""Connected components of links between ids, by rounds of joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sheetlake.llm.scratch import Scratch
from sheetlake.session import written


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in ``links(a long, b long)``.

    Every round points each id at the smallest neighbour it knows, first across
    all its links, then across those to smaller ids; links become stars around
    the smallest ids in a logarithmic number of rounds.  Minima are combined before the
    shuffle, and the joins are between written tables, so a hub with many links
    can be split at run time.  Only a count per round reaches the driver.
    """
    with Scratch(links.sparkSession) as scratch:
        edges = scratch.written(_pairs(links.select("a", "b")), "links")
        while True:
            large = scratch.written(_pairs(_toward_least(edges, True, scratch)), "links")
            small = scratch.written(_pairs(_toward_least(large, False, scratch)), "links")
            if small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty():
                break
            edges = small
        leaves = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
        roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
        return written(leaves.unionByName(roots), "components")


def _pairs(links: DataFrame) -> DataFrame:
    """Distinct links with the larger id first."""
    return (
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _toward_least(edges: DataFrame, larger: bool, scratch: Scratch) -> DataFrame:
    """Links from the larger (or smaller) neighbours of each id to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges
    least = scratch.written(both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m")), "least")
    moved = both.join(least, "a")
    if larger:
        return moved.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return moved.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(
        least.select("a", F.col("_m").alias("b"))
    )
