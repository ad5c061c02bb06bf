"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once per worker.

A text is cut before every single space that a visible character follows.  No
token of either vocabulary reaches over such a place: the byte-level pattern
lets a word take one space in front of it and ends every other match there, and
the word vocabulary drops white space.  So the ids of a text are the ids of its
pieces in order, and a piece that was met before costs one look-up.

A plain piece (Latin letters, digits and marks) is cut by the tokenizer's
pattern and goes to the library's merge model.  Any other piece, and one that
spells an added token, goes through the library's full ``encode``.

Many texts are cut and their distinct pieces numbered by Arrow; Python sees each distinct piece of a
block once.  Pieces are remembered in two generations: when the younger one is full it
replaces the older one, so that what is in use stays.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_PIECES = 400_000
LONGEST_CACHED = 64

_PLAIN = re.compile(r"[\t\n\r !-~À-ÖØ-öø-ſ]*\Z")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_LOOSE_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\s\w]|_)+")
_ID = attrgetter("id")
_CUT = re.compile(r" (?=\S)")
_SPACE_RUN = re.compile(r" \s| \Z")
#: Letters that stay one letter each in lower case.
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-įı-ſ]+\Z")
_MARKS = frozenset(".,;:!?")
#: The same for Arrow, whose \s knows ASCII only.
_ODD = r" [\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]| \z"
#: Bytes of text that are cut and numbered at a time.
BLOCK_BYTES = 4 << 20


def byte_letters() -> list[str]:
    """The visible letter that byte-level vocabularies use for each byte value."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in letters)
    letters.update({b: chr(0x100 + k) for k, b in enumerate(hidden)})
    return [letters[b] for b in range(256)]


class PieceEncoder:
    """Ids of texts as little-endian bytes of the given unsigned type."""

    def __init__(self, path: str, kind: str = "<u4", cached: int = CACHE_PIECES) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.code = {"<u2": "H", "<u4": "I"}[kind]
        self.loose = bool(settings["model"].get("end_of_word_suffix"))
        self.pattern = _LOOSE_WORDS if self.loose else _WORDS
        self.letters = dict(enumerate(byte_letters()))
        self.lead = "" if self.loose else self.letters[32]
        self.tokenize = self.model.tokenize
        self.added = [x["content"] for x in settings["added_tokens"]]
        self.cached = cached
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def word(self, word: str) -> bytes:
        """One match of the pattern that was not met before.  A word with its space is remembered as a piece."""
        if not self.loose and word[0] == " " and self.is_word(word[1:]):
            return self.after_space(word[1:])
        if word.isascii() and word.isprintable():
            spelled = word.replace(" ", self.letters[32])
        else:
            spelled = word.encode().decode("latin-1").translate(self.letters)
        known = self.pack([x.id for x in self.model.tokenize(spelled)])
        if len(self.words) >= self.cached:
            self.words.clear()
        self.words[word] = known
        return known

    def piece(self, piece: str) -> bytes:
        if _PLAIN.match(piece) and not ("<|" in piece and any(x in piece for x in self.added)):
            if self.loose:
                piece = piece.lower()
            words = self.words
            return b"".join([words.get(x) or self.word(x) for x in self.pattern.findall(piece)])
        return self.pack(self.library.encode(piece, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        """The ids of a text, packed."""
        first, *others = _CUT.split(text) if _SPACE_RUN.search(text) else text.split(" ")
        return b"".join([self.piece(first), *map(self.after_space, others)])

    @staticmethod
    def is_word(text: str) -> bool:
        return text.isalpha() and (text.isascii() or _LETTERS.match(text) is not None)

    def after_space(self, rest: str) -> bytes:
        """A piece by what follows its space."""
        return self.pieces.get(rest) or self.remember(rest)

    def remember(self, rest: str) -> bytes:
        """A piece that is not among the younger ones.  Plain words need no cutting."""
        ids = self.older.get(rest)
        if ids is None:
            core = rest[:-1] if rest[-1:] in _MARKS else rest
            if not self.is_word(core):
                ids = self.piece(" " + rest)
            elif core is not rest:
                ids = self.after_space(core) + (self.words.get(rest[-1]) or self.word(rest[-1]))
            else:
                spelled = core.lower() if self.loose else core
                if not core.isascii():
                    spelled = spelled.encode().decode("latin-1").translate(self.letters)
                ids = array(self.code, map(_ID, self.tokenize(self.lead + spelled))).tobytes()
        if len(rest) <= LONGEST_CACHED:
            if 2 * len(self.pieces) >= self.cached:
                self.pieces, self.older = {}, self.pieces
            self.pieces[rest] = ids
        return ids

    def all_ids(self, texts: pa.Array) -> Iterator[bytes]:
        """The packed ids of each text in order; null is empty."""
        size = array(self.code).itemsize
        for lists, parts in _blocks(texts):
            lengths, known, numbers = self._numbered(lists)
            flat = np.frombuffer(b"".join(known), f"<u{size}")
            begins = np.cumsum(lengths) - lengths
            taken = lengths[numbers]
            ends = np.cumsum(taken)
            ids = flat[np.repeat(begins[numbers] - (ends - taken), taken) + np.arange(taken.sum())].tobytes()
            bounds = size * np.concatenate([[0], ends])[lists.offsets.to_numpy()]
            bounds = bounds[[0, -1]] if parts else bounds
            yield from (ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()))

    def all_counts(self, texts: pa.Array) -> Iterator[int]:
        """The number of ids of each text in order; null is empty."""
        for lists, parts in _blocks(texts):
            lengths, _, numbers = self._numbered(lists)
            sums = np.add.reduceat(lengths[numbers], lists.offsets.to_numpy()[:-1])
            yield from [int(sums.sum())] if parts else sums.tolist()

    def _numbered(self, lists: pa.ListArray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Number of ids and packed ids of each distinct piece, and the number of every piece."""
        codes = lists.values.dictionary_encode()
        numbers = codes.indices.to_numpy().astype(np.int64)
        names = codes.dictionary.to_numpy(zero_copy_only=False).tolist()
        get, remember = self.pieces.get, self.remember
        known = [get(x) or remember(x) for x in names]
        # No space comes before the first piece of a text.
        firsts = lists.offsets.to_numpy()[:-1]
        known += [self.piece(names[k]) for k in numbers[firsts].tolist()]
        numbers[firsts] = len(names) + np.arange(len(firsts))
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // array(self.code).itemsize
        return lengths, known, numbers


def _blocks(texts: pa.Array) -> Iterator[tuple[pa.ListArray, bool]]:
    """The pieces of some texts at a time; or of the parts of a single long one, and True."""
    texts = pc.fill_null(texts, "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    first = 0
    while first < len(texts):
        last = first + max(1, int(np.searchsorted(np.cumsum(sizes[first:]), BLOCK_BYTES, "right")))
        if sizes[first] > BLOCK_BYTES:
            yield _pieces(pa.array(_long(texts[first].as_py()), pa.large_string()).cast(pa.string())), True
        else:
            yield _pieces(texts[first:last]), False
        first = last


def _long(text: str) -> list[str]:
    """Parts of a long text that are encoded on their own; a part that begins with its cut's space has an empty first piece."""
    parts, place = [], 0
    while place < len(text):
        cut = _CUT.search(text, place + BLOCK_BYTES)
        end = cut.start() if cut else len(text)
        parts.append(text[place:end])
        place = end
    return parts


def _pieces(texts: pa.Array) -> pa.ListArray:
    odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
    if not odd.any():
        return _compact(pc.split_pattern(texts, " "))
    plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
    others = pa.array([_CUT.split(x) for x in texts.filter(pa.array(odd)).to_pylist()], pa.list_(pa.string()))
    order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
    return _compact(pa.concat_arrays([plain, others]).take(pa.array(np.argsort(order))))


def _compact(lists: pa.ListArray) -> pa.ListArray:
    """The same lists with offsets from 0."""
    return pa.ListArray.from_arrays(lists.offsets, lists.values) if lists.offset == 0 else pa.concat_arrays([lists])


@lru_cache(maxsize=4)
def encoder(path: str, kind: str = "<u4", cached: int = CACHE_PIECES) -> PieceEncoder:
    """One encoder per worker process and setting; it remembers at most ``cached`` pieces and words."""
    return PieceEncoder(path, kind, cached)
