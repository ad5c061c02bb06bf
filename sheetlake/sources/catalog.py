"""Sources and the two relations that every other module works on.

``headers(source, pos, name)`` holds one row per column of each source and
``cells(source, row_no, pos, name, value)`` one row per cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

HEADER_SCHEMA = "source STRING, pos INT, name STRING"


@dataclass(frozen=True)
class Source:
    """One wide table of text columns, or several that share a header.

    Columns are addressed by position (``c0, c1, ...``) and the real names are
    kept beside them, so repeated header names do no harm.  ``row_no`` is the
    row order, used where "the first rows" matter.  Where one frame holds the rows of several
    files, ``members`` names them and the column ``source`` tells whose a row is.
    """

    name: str
    frame: DataFrame
    header: tuple[str, ...]
    members: tuple[str, ...] = ()

    @classmethod
    def of(cls, name: str, frame: DataFrame, order: Column | None = None) -> Source:
        """Wrap a DataFrame; all values are taken as text."""
        texts = [F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(frame.columns)]
        row_no = F.monotonically_increasing_id() if order is None else order
        return cls(name, frame.select(row_no.alias("row_no"), *texts), tuple(frame.columns))

    @property
    def names(self) -> tuple[str, ...]:
        return self.members or (self.name,)

    @property
    def label(self) -> Column:
        """The name of each row's file."""
        return (F.col("source") if self.members else F.lit(self.name)).alias("source")

    @property
    def columns(self) -> list[str]:
        return [f"c{i}" for i in range(len(self.header))]

    def named(self, columns: Sequence[str] | None = None) -> DataFrame:
        """The plain table under its real names."""
        names = self.header if columns is None else columns
        return self.frame.select(*[F.col(f"c{self.header.index(n)}").alias(n) for n in names])


def headers(spark: SparkSession, sources: Iterable[Source]) -> DataFrame:
    """Header relation of the sources; needs no look at the data."""
    rows = [(name, i, n) for s in sources for name in s.names for i, n in enumerate(s.header)]
    return spark.createDataFrame(rows, HEADER_SCHEMA)


def cells(source: Source, positions: Sequence[int] | None = None) -> DataFrame:
    """Cell relation of one source; a missing cell counts as empty text."""
    wanted = range(len(source.header)) if positions is None else positions
    numbered = source.frame.select(
        source.label, "row_no", *[F.coalesce(F.col(f"c{i}"), F.lit("")).alias(str(i)) for i in wanted]
    )
    names = F.array(*[F.lit(n) for n in source.header])
    long = numbered.unpivot(["source", "row_no"], [f"`{i}`" for i in wanted], "pos", "value")
    return long.select(
        "source",
        "row_no",
        F.col("pos").cast("int").alias("pos"),
        F.get(names, F.col("pos").cast("int")).alias("name"),
        "value",
    )


def all_cells(
    sources: Iterable[Source], wanted: Callable[[str], bool] | None = None
) -> DataFrame:
    """Cell relation of many sources, pruned to wanted columns before unpivoting."""
    frames = []
    for s in sources:
        positions = [i for i, n in enumerate(s.header) if wanted is None or wanted(n)]
        if positions:
            frames.append(cells(s, positions))
    return reduce(DataFrame.unionAll, frames)


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
