"""Tokenisers: any ``Column -> ARRAY<STRING>`` function can stand in."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Scripts written without spaces give one token per character, all other
# letters and digits give one token per run.  ASCII is named first because the
# matcher then decides most characters with a single lookup.
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー"
WORD_PATTERN = rf"[a-zA-Z0-9[\p{{L}}\p{{M}}\p{{N}}&&[^{_UNSPACED}]]]+|[{_UNSPACED}]"


def words(text: Column, pattern: str = WORD_PATTERN) -> Column:
    """Words in text order, case kept."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def spaced(text: Column) -> Column:
    """Tokens of text that is already a list of words joined by spaces."""
    return F.array_remove(F.split(text, " "), "")
