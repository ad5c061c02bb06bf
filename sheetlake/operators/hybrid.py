"""Merging keyword and vector hits, and the prompt made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from sheetlake.functions import fixed
from sheetlake.functions.text import preview
from sheetlake.operators.sizes import MAX_ROWS, is_small

KEYWORD_LEG, VECTOR_LEG = 0, 1


def merge_hits(keyword: DataFrame, vector: DataFrame) -> DataFrame:
    """All keyword hits by rank, then all vector hits; an id counts once.

    Both legs are ``(query_id, rank, id)`` with at most k rows per query.
    """
    legs = keyword.select("query_id", F.lit(KEYWORD_LEG).alias("leg"), "rank", "id").unionAll(
        vector.select("query_id", F.lit(VECTOR_LEG).alias("leg"), "rank", "id")
    )
    # Joins further on ask for ids that are not null, but on one side only; asked
    # for here, both uses of the hits keep the same plan and the search runs once.
    legs = legs.filter(F.col("query_id").isNotNull() & F.col("id").isNotNull())
    first = legs.groupBy("query_id", "id").agg(F.min(F.struct("leg", "rank")).alias("place"))
    order = Window.partitionBy("query_id").orderBy("place", "id")
    return first.select(
        "query_id",
        F.row_number().over(order).alias("position"),
        "id",
        F.when(F.col("place.leg") == KEYWORD_LEG, "keyword").otherwise("vector").alias("leg"),
        F.col("place.rank").alias("rank"),
    )


def few_hits(queries: DataFrame, k: int = fixed.TOP_K) -> bool:
    """Whether a batch is so small that its hits, 2k per query, stay few.

    Looks at the queries only, so nothing is searched to find out.
    """
    return is_small(queries.select("query_id"), MAX_ROWS // (2 * k))


def with_contents(hits: DataFrame, docs: DataFrame, few: bool = False) -> DataFrame:
    """Hits with the contents of their document, empty text if there is none.

    The documents are read once and met by the hits.  When the hits are known to
    be few they go to every task, and only texts that were hit leave the scan;
    otherwise both sides are shuffled by id.
    """
    places = hits.select("query_id", "position", "id")
    found = (
        docs.select("id", "contents")
        .join(F.broadcast(places) if few else places, "id")
        .select("query_id", "position", "contents")
    )
    return hits.join(found, ["query_id", "position"], "left").withColumn(
        "contents", F.coalesce("contents", F.lit(""))
    )


def hybrid_search(keyword: DataFrame, vector: DataFrame, docs: DataFrame, few: bool = False) -> DataFrame:
    """Merged hits with contents, at most 2k per query."""
    return with_contents(merge_hits(keyword, vector), docs, few).select(
        "query_id", "position", "id", "leg", "rank", "contents"
    )


def assemble_prompt(
    queries: DataFrame,
    hits: DataFrame,
    separator: str = fixed.CONTEXT_SEPARATOR,
    template: str = fixed.PROMPT_TEMPLATE,
) -> DataFrame:
    """One prompt per query: its contents in order, then the question."""
    before, rest = template.split("{context}")
    between, after = rest.split("{query}")
    # At most 2k contents per query reach each list.
    contexts = hits.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "contents"))).alias("ordered")
    )
    context = F.array_join(F.coalesce(F.col("ordered.contents"), F.array().cast("array<string>")), separator)
    return queries.join(contexts, "query_id", "left").select(
        "query_id",
        F.concat(F.lit(before), context, F.lit(between), F.col("text"), F.lit(after)).alias("prompt"),
    )


def answer_preview(hits: DataFrame, chars: int = fixed.ANSWER_PREVIEW_CHARS) -> DataFrame:
    """The start of every hit's contents, for display beside an answer."""
    return hits.withColumn("contents", preview(F.col("contents"), chars))
