"""Size checks in front of every explicit broadcast, and tasks of bounded size."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

MAX_ROWS = 200_000
MAX_BYTES = 64 * 1024 * 1024

# Text that one task cuts into tokens; their counts take some ten times as much memory.
TASK_BYTES = 16 * 1024 * 1024


def is_small(frame: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Whether a frame stays below both limits.

    Looks at no more than ``max_rows + 1`` rows, so the check costs the same
    for a table of any size.
    """
    width = F.lit(0)
    for name, kind in frame.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(column), F.lit(0)) + 16
        elif kind.startswith("array"):
            width = width + F.coalesce(F.size(column), F.lit(0)) * 8 + 16
        else:
            width = width + 16
    seen = frame.select(width.alias("w")).limit(max_rows + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("bytes")
    ).head()
    return seen.n <= max_rows and seen.bytes <= max_bytes


def spread_texts(texts: DataFrame, key: str, text: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Rows placed by a key in tasks of a bounded amount of text: more text makes more tasks, not larger ones."""
    total = texts.agg(F.sum(F.octet_length(F.col(text)))).head()[0] or 0
    least = texts.sparkSession.sparkContext.defaultParallelism
    return texts.repartition(max(least, math.ceil(total / task_bytes)), key)
