"""A filter of fixed size for a set of ids of any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheetlake.llm.words import mix

BITS = 1 << 24
HASHES = 2


def places(ids: np.ndarray) -> np.ndarray:
    """The bits of each id, one row per hash."""
    return np.stack([mix(ids.view(np.uint64) + np.uint64(k + 1)) % np.uint64(BITS) for k in range(HASHES)])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = places(batch.column(0).to_numpy()).ravel()
        word, inverse = np.unique(bits >> np.uint64(6), return_inverse=True)
        value = np.zeros(len(word), np.uint64)
        np.bitwise_or.at(value, inverse, np.uint64(1) << (bits & np.uint64(63)))
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(value.view(np.int64))], ["word", "bits"])


def key_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter over a single long column without nulls: ``BITS`` bits, however many ids there are."""
    found = ids.mapInArrow(_words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    filled = np.zeros(BITS // 64, np.uint64)
    filled[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return filled


def maybe_in(filled: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """False only for ids that are not in the set."""
    bits = places(ids)
    return ((filled[bits >> np.uint64(6)] >> (bits & np.uint64(63))) & np.uint64(1)).all(axis=0)
