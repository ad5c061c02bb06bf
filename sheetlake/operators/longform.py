"""Wide sources to one long table with a parsed header hierarchy."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from sheetlake.functions import fixed
from sheetlake.functions.headerpath import with_header_path
from sheetlake.functions.text import clean_cell, composite_id, first_year, is_filled
from sheetlake.sources.catalog import Source, union_sources

CLEAN_COLUMNS = (
    "year", "business_id", "concept", "block", "item_index", "detail", "value", "original_column_name",
)


def clean_cells(frame: DataFrame) -> DataFrame:
    """Text columns without nulls and line breaks; other columns untouched."""
    return frame.select(
        *[
            clean_cell(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`")
            for c, t in frame.dtypes
        ]
    )


def unpivot_frame(frame: DataFrame, id_columns: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keep the id columns and turn the others into name and value rows.

    Blank values are left out; rows without any id value stay.  Works on static
    and on streaming frames; no shuffle.
    """
    long = frame.unpivot(
        [f"`{c}`" for c in id_columns],
        [f"`{c}`" for c in columns],
        "original_column_name",
        "value",
    )
    return long.filter(is_filled(F.col("value")))


def unpivot_source(source: Source, id_width: int = 3) -> DataFrame:
    """Long rows of one source: ``source``, its id columns, name and value.

    The first ``id_width`` columns are the id columns and keep their names.
    """
    numbered = source.frame.select(source.label, *[F.col(c).alias(str(i)) for i, c in enumerate(source.columns)])
    ids = [str(i) for i in range(id_width)]
    rest = [str(i) for i in range(id_width, len(source.header))]
    long = unpivot_frame(numbered, ["source", *ids], rest)
    names = F.array(*[F.lit(n) for n in source.header])
    return long.select(
        "source",
        *[F.col(f"`{i}`").alias(n) for i, n in zip(ids, source.header)],
        F.get(names, F.col("original_column_name").cast("int")).alias("original_column_name"),
        "value",
    )


def unpivot_sources(sources: Iterable[Source], id_width: int = 3) -> DataFrame:
    return union_sources([unpivot_source(s, id_width) for s in sources])


def with_business_id(frame: DataFrame, id_parts: Sequence[str] = fixed.ID_PARTS) -> DataFrame:
    """Add ``business_id``; an id part the frame lacks counts as empty text."""
    parts = [F.col(f"`{p}`") if p in frame.columns else F.lit("") for p in id_parts]
    return frame.withColumn("business_id", composite_id(parts))


def clean_long_data(long: DataFrame, id_parts: Sequence[str] = fixed.ID_PARTS) -> DataFrame:
    """Long rows of any sources to the eight text columns of the clean table."""
    filled = with_business_id(long.filter(is_filled(F.col("value"))), id_parts)
    return (
        with_header_path(filled)
        .withColumn("year", first_year(F.col("source")))
        .select(*CLEAN_COLUMNS)
    )
