"""Small column expressions on text. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, functions as F

from sheetlake.functions import fixed

# Unicode white space plus the four ASCII separators.
_SPACE = r"[\s\x1C-\x1F]"
_NON_SPACE = r"(?U)[^\s\x1C-\x1F]"


def is_filled(value: Column) -> Column:
    """True when the text holds at least one non-space character.

    Most texts start with a visible ASCII character, which settles the question
    without a regular expression.
    """
    plain_start = F.ascii(value).between(33, 126)
    return F.coalesce(plain_start | value.rlike(_NON_SPACE), F.lit(False))


def is_blank(value: Column) -> Column:
    return ~is_filled(value)


def strip(value: Column) -> Column:
    left = F.regexp_replace(value, rf"(?U)\A{_SPACE}+", "")
    return F.regexp_replace(left, rf"(?U){_SPACE}+\z", "")


def clean_cell(value: Column) -> Column:
    """Null becomes the empty string, line breaks become spaces."""
    return F.translate(F.coalesce(value, F.lit("")), "\n\r", "  ")


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def contains_any(value: Column, words: Sequence[str]) -> Column:
    return any_of([F.contains(value, F.lit(w)) for w in words])


def count_contained(value: Column, words: Sequence[str]) -> Column:
    """How many of the words occur in the text (each counted once)."""
    hits = [F.contains(value, F.lit(w)).cast("int") for w in words]
    return reduce(add, hits, F.lit(0))


def count_separators(name: Column, separator: str = fixed.PATH_SEPARATOR) -> Column:
    without = F.replace(name, F.lit(separator), F.lit(""))
    return ((F.length(name) - F.length(without)) / len(separator)).cast("int")


def drop_na_tokens(value: Column, tokens: Sequence[str] = fixed.NA_TOKENS) -> Column:
    """Null for cells whose whole text is one of the missing-value tokens."""
    return F.when(~F.array_contains(F.lit(list(tokens)), value), value)


def first_year(source: Column) -> Column:
    """First run of four digits in the source tag, empty text if none."""
    return F.regexp_extract(source, "([0-9]{4})", 1)


def calendar_year(source: Column) -> Column:
    """First ``20xx`` in the source tag as a number, null if none."""
    return F.nullif(F.regexp_extract(source, "(20[0-9]{2})", 1), F.lit("")).cast("int")


def composite_id(parts: Sequence[Column], separator: str = "-") -> Column:
    """Join id parts; a null part counts as empty text."""
    return F.concat_ws(separator, *[F.coalesce(p, F.lit("")) for p in parts])


def sheet_safe_name(name: Column) -> Column:
    """Every character that is no letter or digit becomes one underscore."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}]", "_")


def file_safe_name(name: Column) -> Column:
    """Runs of non-word characters become one underscore; none at the ends."""
    joined = F.regexp_replace(name, r"[^\p{L}\p{N}_]+", "_")
    return F.regexp_replace(joined, r"\A_+|_+\z", "")


def preview(contents: Column, chars: int = fixed.PREVIEW_CHARS) -> Column:
    return F.concat(F.substring(contents, 1, chars), F.lit("..."))


def parent_id(chunk_id: Column) -> Column:
    return F.substring_index(chunk_id, fixed.CHUNK_MARK, 1)


def digits_to_int(text: Column) -> Column:
    """Decimal digits, full-width ones included, as a number."""
    return F.translate(text, "０１２３４５６７８９", "0123456789").cast("int")
