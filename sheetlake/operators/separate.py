"""Splitting repeated column groups off a wide source."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sheetlake.functions import fixed
from sheetlake.functions.text import digits_to_int, is_filled
from sheetlake.operators.sizes import is_small
from sheetlake.sources.catalog import Source, union_sources


def repeated_columns(
    source: Source, pattern: str = fixed.REPEATED_GROUP_PATTERN
) -> list[tuple[int, str, str, str]]:
    """``(position, block, item index, attribute)`` of the repeated columns."""
    matcher = re.compile(pattern)
    matches = ((i, matcher.match(n)) for i, n in enumerate(source.header))
    return [(i, *m.groups()) for i, m in matches if m]


def separate_main(source: Source, pattern: str = fixed.REPEATED_GROUP_PATTERN) -> DataFrame:
    """The rows without any repeated column, under the real names."""
    repeated = {i for i, *_ in repeated_columns(source, pattern)}
    return source.frame.select(
        *[F.col(f"c{i}").alias(n) for i, n in enumerate(source.header) if i not in repeated]
    )


def separate_children(
    source: Source,
    key_column: str,
    pattern: str = fixed.REPEATED_GROUP_PATTERN,
    attributes: Mapping[str, str] = fixed.ATTRIBUTE_NAMES,
    keep_block: bool = False,
    na_tokens: Sequence[str] = fixed.NA_TOKENS,
) -> DataFrame:
    """One child row per source row and item index that has any attribute.

    All columns of an item sit in the same row, so the children are built row
    by row without a shuffle.  Where several columns give the same attribute
    (equal index in different blocks) the last filled one wins.
    """
    key = F.col(f"c{source.header.index(key_column)}")
    return _children(source, source.frame, key, F.lit(source.name), pattern, attributes, keep_block, na_tokens)


def _children(
    source: Source,
    frame: DataFrame,
    key: Column,
    label: Column,
    pattern: str = fixed.REPEATED_GROUP_PATTERN,
    attributes: Mapping[str, str] = fixed.ATTRIBUTE_NAMES,
    keep_block: bool = False,
    na_tokens: Sequence[str] = fixed.NA_TOKENS,
) -> DataFrame:
    items: dict[tuple[str, str], dict[str, list[int]]] = {}
    for position, block, index, attribute in repeated_columns(source, pattern):
        if attribute in attributes:
            group = items.setdefault((block if keep_block else "", index), {})
            group.setdefault(attributes[attribute], []).append(position)

    names = list(attributes.values())
    kind = "array<struct<block:string,expenditure_index:int,{}>>".format(
        ",".join(f"{n}:array<string>" for n in names)
    )
    structs = [
        F.struct(
            F.lit(block).alias("block"),
            digits_to_int(F.lit(index)).alias("expenditure_index"),
            *[F.array(*[F.col(f"c{p}") for p in reversed(group.get(n, []))]).alias(n) for n in names],
        )
        for (block, index), group in items.items()
    ]

    def filled(cell):
        return is_filled(cell) & ~F.array_contains(missing, cell)

    missing = F.lit(list(na_tokens))
    # The cells of an item are exploded as they are and looked at afterwards:
    # the plan then grows with the attributes, not with the columns.
    items_of_row = frame.filter(filled(key)).select(
        label.alias("source"), key.alias("project_id"), F.inline(F.array(*structs).cast(kind))
    )
    last_filled = {n: F.get(F.filter(F.col(n), filled), F.lit(0)) for n in names}
    children = items_of_row.withColumns(last_filled).filter(F.coalesce(*names).isNotNull())
    return children.select(
        "source",
        "project_id",
        *(["block"] if keep_block else []),
        "expenditure_index",
        *names,
    )


def separate(
    sources: Sequence[Source], key_map: DataFrame, **options
) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Main tables per source and one child table over all sources.

    ``key_map(source, key_column)`` has one row per source; sources without a
    key column, or whose key column is absent, are left out.
    """
    names = [s.name for s in sources]
    chosen = {
        r.source: r.key_column
        for r in key_map.filter(F.col("source").isin(names) & F.col("key_column").isNotNull()).collect()
    }
    usable = [s for s in sources if chosen.get(s.name) in s.header]
    mains = {s.name: separate_main(s) for s in usable}
    children = [separate_children(s, chosen[s.name], **options) for s in usable]
    return mains, (union_sources(children) if children else None)


def keyed_rows(group: Source, key_map: DataFrame) -> DataFrame:
    """The rows of a group's files that have a key column, with its cell as ``project_id``.

    Files of one header may have different key columns; the place of each file's comes with a join.
    """
    spark = group.frame.sparkSession
    places: dict[str, int] = {}
    for i, name in enumerate(group.header):
        places.setdefault(name, i)
    known = spark.createDataFrame(list(places.items()), "key_column STRING, key_pos INT")
    keys = key_map.join(known, "key_column").select("source", "key_pos")
    rows = group.frame.select(group.label, *group.columns)
    found = rows.join(F.broadcast(keys) if is_small(keys) else keys, "source")
    return found.withColumn("project_id", F.get(F.array(*group.columns), F.col("key_pos"))).drop("key_pos")


def separate_groups(
    groups: Sequence[Source], key_map: DataFrame, pattern: str = fixed.REPEATED_GROUP_PATTERN, **options
) -> tuple[DataFrame | None, DataFrame | None]:
    """Main rows and child rows of all files, for sources that stand for all files of one header.

    ``key_map(source, key_column)`` has one row per file; files without a key column, or whose key column is
    absent, are left out.  Main rows have the columns of all headers by name, with nulls where a file has no such
    column, and ``source``; of a name that a header repeats, the first column counts.  The plan has one branch per header, however many files there are.
    """
    mains, children = [], []
    for group in groups:
        rows = keyed_rows(group, key_map)
        repeated = {i for i, *_ in repeated_columns(group, pattern)}
        names: dict[str, int] = {}
        for i, name in enumerate(group.header):
            if i not in repeated:
                names.setdefault(name, i)
        mains.append(rows.select("source", *[F.col(f"c{i}").alias(n) for n, i in names.items()]))
        if repeated:
            children.append(_children(group, rows, F.col("project_id"), F.col("source"), pattern, **options))
    return (union_sources(mains) if mains else None), (union_sources(children) if children else None)
