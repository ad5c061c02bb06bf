"""Parse hierarchical header names such as ``concept-block-index-detail``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from sheetlake.functions import fixed


def with_header_path(
    frame: DataFrame,
    name: str = "original_column_name",
    separator: str = fixed.PATH_SEPARATOR,
    payee_suffix: str = fixed.PAYEE_SUFFIX,
    group_marker: str = fixed.GROUP_MARKER,
) -> DataFrame:
    """Add ``concept, block, item_index, detail`` parsed from a header name.

    Two shapes carry an index: ``concept-<x><suffix>-index-detail...`` and
    ``concept-<marker>-detail-index``.  Any other name keeps itself as detail.

    The parts are a column of their own, so that the name is cut once per row
    and not once per use.  The four results depend on nothing but the parts:
    results that build on each other would grow without measure when a filter
    on one of them is pushed below the parsing.
    """
    parts = F.col("_parts")
    second, third, fourth = (F.get(parts, F.lit(i)) for i in (1, 2, 3))

    def is_index(text: Column) -> Column:
        return text.rlike("\\A[0-9]+\\z")

    payee, group = F.endswith(second, F.lit(payee_suffix)), second == group_marker
    tail = F.slice(parts, F.lit(4), F.greatest(F.size(parts) - 3, F.lit(0)))
    return (
        frame.withColumn("_parts", F.split(name, re.escape(separator)))
        .withColumns(
            {
                "concept": F.get(parts, F.lit(0)),
                "block": F.when(payee | group, second),
                "item_index": F.when(payee & is_index(third), third).when(group & is_index(fourth), fourth),
                "detail": F.when(payee & is_index(third), F.array_join(tail, separator))
                .when(group & is_index(fourth), third)
                .otherwise(F.col(name)),
            }
        )
        .drop("_parts")
    )
