"""Language by rank-order profiles of character n-grams and their out-of-place distance."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheetlake.llm.labelled import crc_mod
from sheetlake.llm.ship import ship
from sheetlake.operators.topn import first_n

PROFILE = 300
SAMPLE_PER_LANGUAGE = 1_000
MOST_LANGUAGES = 2_000
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")
_SPACE = np.int64(ord(" "))
_BITS = np.int64(21)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of one to three characters of the words of a text, with their counts.

    Words are runs of letters in lower case with one space on either side; a run is a number of
    21 bits a character and never reaches over a space.
    """
    letters = f" {_OTHER.sub(' ', text.lower()).strip()} "
    one = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    gap = one == _SPACE
    two = one[:-1] << _BITS | one[1:]
    three = two[:-1] << _BITS | one[2:]
    return np.unique(np.concatenate([one[~gap], two[~(gap[:-1] & gap[1:])], three[~gap[1:-1]]]), return_counts=True)


def profile(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent runs in order; equal counts by the run itself."""
    if len(counts) > 4 * size:
        least = np.partition(counts, -size)[-size]
        keep = counts >= least
        grams, counts = grams[keep], counts[keep]
    return grams[np.lexsort((grams, -counts))[:size]]


class Profiles:
    """The learned profiles, with the rank of every run in each language."""

    def __init__(self, ranked: dict[str, list[int]]) -> None:
        self.languages = sorted(ranked)
        self.grams = np.unique(np.array([g for x in ranked.values() for g in x], np.int64))
        self.ranks = np.full((len(ranked), len(self.grams) + 1), -1, np.int64)
        for k, language in enumerate(self.languages):
            self.ranks[k, np.searchsorted(self.grams, ranked[language])] = np.arange(len(ranked[language]))

    def distances(self, document: np.ndarray) -> np.ndarray:
        """Out-of-place distance to each language; a run that a profile lacks is ``PROFILE`` places off."""
        place = np.minimum(np.searchsorted(self.grams, document), len(self.grams) - 1)
        place = np.where(self.grams[place] == document, place, len(self.grams))
        ranks = self.ranks[:, place]
        off = np.abs(ranks - np.arange(len(document)))
        return np.where(ranks < 0, PROFILE, np.minimum(off, PROFILE)).sum(axis=1)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: how much farther the second language is, relative to its distance."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        distances = self.distances(profile(*gram_counts(text)))
        order = np.lexsort((np.arange(len(distances)), distances))
        best = distances[order[0]]
        other = distances[order[1]] if len(order) > 1 else PROFILE * PROFILE
        return self.languages[order[0]], float((other - best) / other) if other else 0.0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_language: dict[str, list] = {}
        for text, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_language.setdefault(language, []).append(gram_counts(text))
        for language, found in by_language.items():
            grams, inverse = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([x[1] for x in found])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"]
            )


def learn(docs: DataFrame, rows: int = SAMPLE_PER_LANGUAGE) -> Profiles:
    """Profiles from at most ``rows`` texts per language, chosen by a hash of their ids.

    The learned profiles have ``PROFILE`` rows a language; more than
    ``MOST_LANGUAGES`` languages are refused, as such a column holds something else.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    keys = known.select("lang", "doc_id", F.xxhash64("doc_id").alias("_order"))
    chosen = first_n(keys, ["lang"], [F.col("_order"), F.col("doc_id")], rows).select("lang", "doc_id").distinct()
    counts = (
        known.join(chosen, ["doc_id", "lang"], "left_semi")
        .select("text", "lang")
        .mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    top = first_n(counts, ["lang"], [F.col("n").desc(), F.col("gram")], PROFILE)
    found = top.limit(MOST_LANGUAGES * PROFILE + 1).collect()
    if len(found) > MOST_LANGUAGES * PROFILE:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    ranked: dict[str, list] = {}
    for row in found:
        ranked.setdefault(row.lang, []).append((-row.n, row.gram))
    return Profiles({k: [gram for _, gram in sorted(x)] for k, x in ranked.items()})


def _predictor(profiles: Profiles) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return predict


def languages(docs: DataFrame, rows: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs(doc_id, text, lang)``.

    Profiles are learned from rows that are not held out, with a language and a
    text; a prediction sees the text only.  A text that is null or has no letter is
    ``und`` with score 0, and so is every text where nothing could be learned.  A row without ``doc_id`` is held out.
    Ties go to the language that sorts first.  Other columns are ignored.
    """
    ship(docs.sparkSession)
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(True)))
    profiles = learn(docs.where("not held_out"), rows)
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        _predictor(profiles), "doc_id long, held_out boolean, lang_pred string, score double"
    )
