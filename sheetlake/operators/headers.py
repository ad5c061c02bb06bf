"""Comparing and ranking header names across sources.

Every function takes the header relation ``headers(source, pos, name)``.  The
relation may be large, and one source or one name may hold much of it, so all
counts are aggregated before they are shuffled and nothing gathers the headers
of one source in one place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sheetlake.functions import fixed
from sheetlake.functions.scoring import amount_tenths, exclusivity
from sheetlake.functions.text import contains_any


def candidate_headers(
    headers: DataFrame, words: Sequence[str], exclusions: Sequence[str] = ()
) -> DataFrame:
    """Headers that contain any of the words and none of the exclusions."""
    name = F.col("name")
    return headers.filter(contains_any(name, words) & ~contains_any(name, exclusions))


def explore_keyword(headers: DataFrame, keyword: str = fixed.EXPLORE_KEYWORD) -> DataFrame:
    """Distinct header names that contain the keyword, in name order."""
    return headers.filter(F.contains("name", F.lit(keyword))).select("name").distinct().orderBy("name")


def source_names(headers: DataFrame) -> list[str]:
    """Sorted source names: the columns of a matrix, so as few as a table can have."""
    return [r.source for r in headers.select("source").distinct().orderBy("source").collect()]


def presence(headers: DataFrame) -> DataFrame:
    """Which name occurs in which source, one row per pair that exists, for any number of sources."""
    return headers.select("name", "source").distinct().withColumn("present", F.lit(1))


def presence_matrix(headers: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """One row per name, one 0/1 column per source, in name order."""
    columns = source_names(headers) if sources is None else list(sources)
    wide = presence(headers).groupBy("name").pivot("source", columns).agg(F.first("present"))
    return wide.na.fill(0).orderBy("name")


def presence_count(headers: DataFrame) -> DataFrame:
    """In how many sources each name occurs."""
    return presence(headers).groupBy("name").agg(F.count("*").alias("presence_count"))


def matrix_row_sums(matrix: DataFrame, name: str = "name") -> DataFrame:
    """Presence count taken from a stored matrix instead of the headers."""
    marks = [F.coalesce((F.col(f"`{c}`").cast("string") == "1").cast("int"), F.lit(0))
             for c in matrix.columns if c != name]
    total = F.aggregate(F.array(*marks), F.lit(0), lambda a, x: a + x)
    return matrix.select(name, total.cast("long").alias("presence_count"))


def keyword_hits(
    headers: DataFrame, hypothesis: Mapping[str, Sequence[str]] = fixed.KEYWORD_HYPOTHESIS
) -> DataFrame:
    """Occurrences and sources of every keyword, one row per target and keyword."""
    per_source = keyword_sources(headers, hypothesis)
    return per_source.groupBy("target", "keyword").agg(
        F.sum("occurrences").alias("total_occurrences"),
        F.count("*").alias("found_in_sources_count"),
    )


def keyword_sources(
    headers: DataFrame, hypothesis: Mapping[str, Sequence[str]] = fixed.KEYWORD_HYPOTHESIS
) -> DataFrame:
    """The sources in which every keyword occurs, one row each."""
    targets = F.array(
        *[
            F.struct(F.lit(t).alias("target"), F.lit(w).alias("keyword"))
            for t, words in hypothesis.items()
            for w in words
        ]
    )
    found = F.filter(targets, lambda k: F.contains(F.col("name"), k["keyword"]))
    return (
        headers.select("source", F.explode(found).alias("hit"))
        .groupBy("hit.target", "hit.keyword", "source")
        .agg(F.count("*").alias("occurrences"))
    )


def signatures(headers: DataFrame) -> DataFrame:
    """Column count, total header length and two order-free hash sums of (place, name) of every source."""
    hashes = (F.xxhash64("pos", "name"), F.xxhash64(F.lit(1), "name", "pos"))
    sums = [F.sum(x.cast("decimal(20,0)")).alias(f"_sum{i}") for i, x in enumerate(hashes)]
    return headers.groupBy("source").agg(
        F.count("*").alias("column_count"), F.sum(F.length("name")).alias("total_length"), *sums
    )


def _groups(signed: DataFrame) -> DataFrame:
    """One row per column count and total length; ``_first`` holds the sums of the first source by name."""
    same = (F.min("_sum0") == F.max("_sum0")) & (F.min("_sum1") == F.max("_sum1"))
    return signed.groupBy("column_count", "total_length").agg(
        F.count("*").alias("n_sources"),
        same.alias("consistent"),
        F.min_by(F.struct("_sum0", "_sum1"), "source").alias("_first"),
    )


def header_types(headers: DataFrame) -> DataFrame:
    """Groups of sources with equal column count and total header length.

    A group is consistent when all its sources carry the same names in the same
    places, which two 64-bit hash sums per source tell without gathering any
    header list.
    """
    groups = _number_types(_groups(signatures(headers)))
    return groups.select("type_no", "column_count", "total_length", "n_sources", "consistent")


def _number_types(groups: DataFrame) -> DataFrame:
    """Number the groups in order of column count, then total length.

    Ranks are taken inside one column count and shifted by the number of groups
    below it, so the only global window runs over the distinct column counts.
    """
    inside = Window.partitionBy("column_count").orderBy("total_length")
    below = Window.orderBy("column_count").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        groups.groupBy("column_count")
        .agg(F.count("*").alias("n_types"))
        .select("column_count", F.coalesce(F.sum("n_types").over(below), F.lit(0)).alias("shift"))
    )
    return groups.join(shifts, "column_count").withColumn(
        "type_no", F.col("shift") + F.row_number().over(inside)
    )


def header_type_members(headers: DataFrame) -> DataFrame:
    """The sources of every header type, one row per source.

    ``matches_first`` tells whether a source has the names of its group's first one, by source name.
    """
    signed = signatures(headers)
    types = _number_types(_groups(signed))
    return signed.join(types, ["column_count", "total_length"]).select(
        "type_no", "source", "consistent", (F.struct("_sum0", "_sum1") == F.col("_first")).alias("matches_first")
    )


def rank_headers(headers: DataFrame, n: int | None = None, **weights) -> DataFrame:
    """Names that look like amounts, best first.

    Scores add up over every occurrence.  Names are counted before they are
    scored, so each distinct name is scored once.
    """
    counted = headers.groupBy("name", "source").agg(F.count("*").alias("n"))
    named = counted.groupBy("name").agg(
        F.sum("n").alias("occurrences"), F.count("*").alias("found_in_sources_count")
    )
    tenths = F.col("occurrences") * amount_tenths(F.col("name"), **weights)
    ranked = (
        named.withColumn("tenths", tenths)
        .filter(F.col("tenths") > 0)
        .orderBy(F.desc("tenths"), "name")
        .select(
            F.col("name").alias("header_name"),
            F.round(F.col("tenths") / 10, 2).alias("score"),
            "found_in_sources_count",
        )
    )
    return ranked if n is None else ranked.limit(n)


def exclusivity_scores(
    headers: DataFrame, targets: Mapping[str, Sequence[str]] = fixed.METADATA_TARGETS
) -> DataFrame:
    """Positive exclusivity scores of every header for every target."""
    scores = F.array(
        *[
            F.struct(F.lit(t).alias("target"), exclusivity(F.col("name"), t, targets).alias("score"))
            for t in targets
        ]
    )
    positive = F.filter(scores, lambda s: s["score"] > 0)
    return headers.select("source", "pos", "name", F.explode(positive).alias("s")).select(
        "source", "pos", "name", "s.target", "s.score"
    )
