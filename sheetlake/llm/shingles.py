"""Sets of word shingles and their minwise sketches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from sheetlake.llm.words import each_text, mix

SKETCH = 128
#: Members whose hashes are held at once; they fit a core's cache.
BLOCK = 256

_ODD = np.random.default_rng(7).integers(1, 1 << 63, SKETCH, dtype=np.uint64) | np.uint64(1)
_FLIP = np.random.default_rng(8).integers(1, 1 << 63, SKETCH, dtype=np.uint64)


def folded(text: str | None) -> bytes:
    """A-Z in lower case, as bytes; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``size`` words; of fewer words, the whole run."""
    if not len(words):
        return words
    size = min(size, len(words))
    runs = len(words) - size + 1
    together = np.zeros(runs, np.uint64)
    for k in range(size):
        together = mix(together + words[k : k + runs] + np.uint64(k + 1))
    return np.unique(together + np.uint64(size))


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """The set of each text, in order."""
    for words in each_text([folded(x) for x in texts]):
        yield shingle_set(words, size)


def sketch(members: np.ndarray) -> np.ndarray:
    """For each of ``SKETCH`` hash functions the smallest value over the set."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    hashes = np.empty((min(BLOCK, len(members)), SKETCH), np.uint64)
    for first in range(0, len(members), BLOCK):
        some = members[first : first + BLOCK, None]
        block = np.bitwise_xor(some, _FLIP, out=hashes[: len(some)])
        np.multiply(block, _ODD, out=block)
        np.minimum(least, block.min(axis=0), out=least)
    return least


def set_key(members: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a and b| >= percent * |a or b|, for sorted sets of distinct values."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    place = np.searchsorted(large, small)
    both = int((large[np.minimum(place, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)
