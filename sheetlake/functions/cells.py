"""Labels for cells and columns: cell type, dominant type, length bin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from sheetlake.functions import fixed
from sheetlake.functions.text import is_filled

CELL_TYPES = ("empty", "bool", "int", "float", "text")

# What counts as a number follows the usual scripting-language literals:
# surrounding space, a sign, underscores between digits, any decimal digits.
_DIGITS = r"\p{Nd}+(?:_\p{Nd}+)*"
_PAD = r"[\s\x1C-\x1F]*"
_INT = rf"(?U)\A{_PAD}[+-]?{_DIGITS}{_PAD}\z"
_FLOAT = (
    rf"(?iU)\A{_PAD}[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
    rf"(?:e[+-]?{_DIGITS})?|nan|inf|infinity){_PAD}\z"
)


def cell_type(value: Column) -> Column:
    return (
        F.when(~is_filled(value), "empty")
        .when(F.lower(value).isin("true", "false"), "bool")
        .when(value.rlike(_INT), "int")
        .when(value.rlike(_FLOAT), "float")
        .otherwise("text")
    )


def dominant_type(
    rows: Column,
    empty: Column,
    ints: Column,
    floats: Column,
    bools: Column,
    texts: Column,
    threshold: float = fixed.DOMINANCE,
) -> Column:
    filled = rows - empty
    label = (
        F.when(rows == 0, "empty_column")
        .when(filled == 0, "fully_empty")
        .when(empty / rows >= threshold, "mostly_empty")
    )
    for count, name in ((ints, "int"), (floats, "float"), (bools, "bool"), (texts, "text")):
        label = label.when(count / filled >= threshold, f"mostly_{name}")
    return label.otherwise("mixed")


def bin_labels(bins: Sequence[int] = fixed.LENGTH_BINS) -> list[str]:
    return [str(b) for b in bins] + [f"{bins[-1]}+"]


def bin_number(length: Column, bins: Sequence[int] = fixed.LENGTH_BINS) -> Column:
    """Ordinal of the smallest upper limit that holds the length."""
    number = F.when(length <= bins[0], 0)
    for i, limit in enumerate(bins[1:], start=1):
        number = number.when(length <= limit, i)
    return number.otherwise(len(bins))


def bin_label(number: Column, bins: Sequence[int] = fixed.LENGTH_BINS) -> Column:
    return F.get(F.array(*[F.lit(x) for x in bin_labels(bins)]), number)
