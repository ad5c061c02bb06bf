"""Hashes of all words of a batch of texts in a few array operations.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return.  Its hash is a polynomial in a fixed odd base over random values
per byte, modulo 2**64, taken from one running sum over the whole buffer, then
mixed.  Such polynomials have known collisions between long words, so words of more than
``LONGEST_SUM`` bytes are hashed by BLAKE2b.  A text of any length is worked on in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np

BLOCK_BYTES = 1 << 20
LONGEST_SUM = 256

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

_BASE = 0x9E3779B97F4A7C15 | 5
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _run_of_products(factor: int, size: int) -> np.ndarray:
    steps = np.full(size, factor, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


class _Powers:
    """Powers of the base and of its inverse, as many as were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, BLOCK_BYTES + 1)
            self.up = _run_of_products(_BASE, size)
            self.down = _run_of_products(pow(_BASE, -1, 1 << 64), size)
        return self.up, self.down


_powers = _Powers()


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a buffer."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~SPACES[raw]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * up[: len(raw)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes = mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for k in np.flatnonzero(ends - starts > LONGEST_SUM).tolist():
        hashes[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return starts, hashes


def pieces(text: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """A long text in blocks that end at white space; a longer word makes its block longer."""
    place = 0
    while place < len(text):
        end = min(len(text), place + size)
        if end < len(text):
            cut = max(text.rfind(c, place, end) for c in (b" ", b"\n"))
            if cut <= place:
                found = [x for x in (text.find(c, end) for c in (b" ", b"\n")) if x >= 0]
                cut = min(found, default=len(text))
            end = cut
        yield text[place:end]
        place = end if end > place else len(text)


def each_text(texts: Sequence[bytes]) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order."""
    group: list[bytes] = []
    size = 0

    def grouped() -> Iterable[np.ndarray]:
        starts, hashes = hash_words(b"\n".join(group))
        firsts = np.cumsum([0, *(len(x) + 1 for x in group[:-1])])
        bounds = [*np.searchsorted(starts, firsts).tolist(), len(hashes)]
        return [hashes[a:b] for a, b in zip(bounds, bounds[1:])]

    for text in texts:
        if group and size + len(text) > BLOCK_BYTES:
            yield from grouped()
            group, size = [], 0
        if len(text) > BLOCK_BYTES:
            yield np.concatenate([hash_words(x)[1] for x in pieces(text)])
        else:
            group.append(text)
            size += len(text) + 1
    if group:
        yield from grouped()
