"""Scores that rank header names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from sheetlake.functions import fixed
from sheetlake.functions.text import contains_any, count_contained, count_separators


def exclusivity(name: Column, target: str, targets: Mapping[str, Sequence[str]]) -> Column:
    """1.0 for an own keyword, minus 0.5 for every other target also named."""
    others = [contains_any(name, words).cast("int") for t, words in targets.items() if t != target]
    foreign = reduce(add, others, F.lit(0))
    return F.when(contains_any(name, targets[target]), 1.0 - 0.5 * foreign).otherwise(F.lit(0.0))


def amount_tenths(
    name: Column,
    categories: Sequence[Sequence[str]] = fixed.RANK_CATEGORIES,
    fallback: str = fixed.RANK_FALLBACK,
    exclusions: Sequence[str] = fixed.RANK_EXCLUSIONS,
    last_part_words: Sequence[str] = fixed.RANK_LAST_PART,
    question: str = fixed.QUESTION_PATTERN,
) -> Column:
    """How much a header looks like an amount, in whole tenths.

    All weights are multiples of 0.1, so whole tenths keep sums exact.  Null
    when the name is no candidate at all.
    """
    named = reduce(add, [contains_any(name, words).cast("int") for words in categories])
    base = F.when(named > 0, named * 20).when(F.contains(name, F.lit(fallback)), 1)
    question_form = name.rlike(question).cast("int")
    last = F.substring_index(name, fixed.PATH_SEPARATOR, -1)
    nested = F.contains(name, F.lit(fixed.PATH_SEPARATOR)) & contains_any(last, last_part_words)
    return base - 15 * count_contained(name, exclusions) - 15 * question_form + 5 * nested.cast("int")


def key_name_score(
    name: Column,
    keywords: Sequence[str] = fixed.KEY_KEYWORDS,
    bonus: Sequence[str] = fixed.KEY_BONUS,
    exclusions: Sequence[str] = fixed.KEY_EXCLUSIONS,
    minimum: float = fixed.KEY_MIN_SCORE,
) -> Column:
    """How much a name looks like a record key; null when it is no candidate."""
    score = (
        100
        + 100 * count_contained(name, bonus)
        - 1000 * count_contained(name, exclusions)
        - 50 * count_separators(name)
        - F.length(name)
    )
    return F.when(contains_any(name, keywords) & (score > minimum), score.cast("double"))
