"""Ids, shards, packing and rank coding against the tokenizer libraries on whole texts."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from sheetlake.llm import encode, packing, rankcoder, wavelet
from sheetlake.llm.encode import encoder

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")

BYTE = str(public_tokenizers.path("byte_bpe_50k.json"))
WORD = str(public_tokenizers.path("word_bpe_49k.json"))
RANKS = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PARTS = ["a", "B", " ", "  ", "\n", "\t", "'s", "'ll", "1", "23", "é", "Σ", "ß", "中", "🙂", "<|endoftext|>", "_", "-", "..."]
PARTS += [" ", "　", "é", "İ", "½", "\r\n", "don't", "ſ", "\x1c", "x" * 30, " " * 20, "Word ", "the "]


def texts(n: int, longest: int) -> list[str | None]:
    pick = random.Random(n)
    return [None, "", *("".join(pick.choice(PARTS) for _ in range(pick.randint(0, longest))) for _ in range(n))]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_give_the_ids_of_the_whole_text(path):
    whole, parts = tokenizers.Tokenizer.from_file(path), encoder(path)
    for text in texts(3000, 25)[1:]:
        assert np.frombuffer(parts.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_a_word_is_tokenized_once_whatever_follows_it():
    parts, text, said = encode.PieceEncoder(BYTE), "x alpha alpha. alpha, alpha.\nBeta alpha-1 alpha's élan élan! alpha", []

    class Counted:
        def __init__(self, model):
            self.model = model

        def tokenize(self, word):
            said.append(word)
            return self.model.tokenize(word)

    parts.model = Counted(parts.model)
    parts.tokenize = parts.model.tokenize
    whole = tokenizers.Tokenizer.from_file(BYTE).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(parts.encode(text), "<u4").tolist() == whole
    assert max(said.count(x) for x in said) == 1 and sum("alpha" in x for x in said) == 1


@pytest.mark.parametrize("kind, width", [("<u2", 16), ("<u4", 32)])
def test_wavelet_matrix_of_many_parts(kind, width, monkeypatch):
    pick = np.random.default_rng(2)
    for size in (63, 64, 65, 128, 1000):
        ids = pick.integers(0, 1 << (width - 1), size).astype(kind)
        ids[: size // 2] = 7
        whole = wavelet.WaveletMatrix.build(ids, width)
        with monkeypatch.context() as patch:
            patch.setattr(wavelet, "PARTED_IDS", 64)
            matrix = wavelet.WaveletMatrix.build(ids, width)
            assert [x.tolist() for x in matrix.planes + matrix.ranks] == [x.tolist() for x in whole.planes + whole.ranks]
            assert matrix.all_ids().tolist() == ids.tolist()
        assert [whole.access(k) for k in range(size)] == ids.tolist()


def test_wavelet_matrix_answers_like_the_plain_sequence():
    pick = np.random.default_rng(1)
    for size, top in ((0, 5), (1, 5), (2000, 3), (5000, 60_000)):
        ids = pick.integers(0, top, size).astype("<u2")
        matrix = wavelet.WaveletMatrix.build(ids, 16)
        assert matrix.all_ids().tolist() == ids.tolist()
        for place in pick.integers(0, size, 20).tolist() if size else []:
            assert matrix.access(place) == ids[place]
        for value in [*np.unique(ids)[:10].tolist(), 65_535]:
            places = np.flatnonzero(ids == value)
            assert matrix.rank(value, size) == len(places)
            assert matrix.rank(value, size // 2) == int((ids[: size // 2] == value).sum())
            assert [matrix.select(value, k) for k in range(len(places))][:50] == places[:50].tolist()
            assert matrix.select(value, len(places)) == -1
    with pytest.raises(IndexError):
        wavelet.WaveletMatrix.build(np.zeros(3, "<u2"), 16).access(3)


def test_shards_hold_the_ids_in_order(spark, tmp_path):
    rows = [(k * 3, x, "clash") for k, x in enumerate(texts(120, 40))] + [(None, "no id", "x"), (9, "again", "x"), (9, "again", "x")]
    random.Random(0).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    path = str(tmp_path / "shards")
    wavelet.write_token_shards(docs, path, BYTE, 50_257, shard_tokens=300)
    found = {}
    for row in wavelet.token_digests(spark, path).collect():
        found.setdefault(row.start, []).append((row.doc_id, row.n_tokens, row.ids_crc32))
    whole = tokenizers.Tokenizer.from_file(BYTE)
    start = 0
    for doc_id, text, _ in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert found[start] == [(doc_id, len(ids), zlib.crc32(ids.tobytes()))]
        start += len(ids)
    shards = wavelet.read_shards(spark, path)
    assert shards.count() > 5
    assert wavelet.occurrences(spark, path, 0).agg({"n": "sum"}).head()[0] == len(rows)
    assert len(found) == len(rows)


def test_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    wavelet.write_token_shards(docs, str(tmp_path / "none"), BYTE, 50_257)
    assert wavelet.token_digests(spark, str(tmp_path / "none")).count() == 0
    assert packing.packed_sequences(docs, WORD).count() == 0
    assert rankcoder.encoded_digests(docs, RANKS, public_tokenizers.PATTERN).count() == 0


def brute_bins(sizes: list[int], limit: int) -> int:
    """The least number of bins, by search."""
    best = len(sizes)

    def place(k: int, bins: list[int]) -> None:
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + sizes[k] <= limit:
                bins[b] += sizes[k]
                place(k + 1, bins)
                bins[b] -= sizes[k]
        place(k + 1, [*bins, sizes[k]])

    place(0, [])
    return best


def test_bounds_hold_and_best_fit_is_valid():
    pick = random.Random(3)
    tight = 0
    for _ in range(200):
        sizes = sorted((pick.randint(1, 20) for _ in range(pick.randint(1, 9))), reverse=True)
        least = brute_bins(sizes, 20)
        bound = packing.lower_bound(np.bincount(sizes, minlength=21), 20)
        assert bound <= least
        tight += bound == least
        bins, offsets = packing.best_fit(np.array(sizes), 20)
        assert bins.max() + 1 >= least
        for b in range(bins.max() + 1):
            own = [(o, s) for o, s, x in zip(offsets.tolist(), sizes, bins.tolist()) if x == b]
            place = 0
            for offset, size in sorted(own):
                assert offset == place
                place += size
            assert place <= 20
    assert tight > 150


def test_packing_is_gapless_and_near_the_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 60)
    pick = random.Random(5)
    rows = [(k, "word " * pick.choice([0, 1, 5, 30, 63, 64, 65, 100, 200]), 1.0) for k in range(400)]
    rows += [(None, None, 1.0), (7, "twice", 1.0), (7, "twice", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length double")
    found = packing.packed_sequences(docs, WORD, limit=64).collect()
    whole = tokenizers.Tokenizer.from_file(WORD)
    want = []
    for doc_id, text, _ in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), 64):
            some = ids[k : k + 64]
            want.append((str(doc_id), k // 64, k, len(some), zlib.crc32(some.tobytes())))
    assert sorted((str(x.doc_id), x.piece, x.start, x.length, x.ids_crc32) for x in found) == sorted(want)
    sequences = {}
    for x in found:
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= 64
    bound = packing.lower_bound(np.bincount([x[3] for x in want], minlength=65), 64)
    assert bound <= len(sequences) <= bound + 3


@pytest.mark.parametrize(("chunk", "overlap"), [(40, 20), (64, 16), (16_384, 512)])
def test_stitched_chunks_match_the_library(spark, chunk, overlap):
    rows = list(enumerate(texts(300, 120))) + [(900, "a" * 500), (901, " " * 500), (902, "é🙂" * 300), (None, "none"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        digests = (hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (text or "").encode()))
        want.append((str(doc_id), len(ids), *digests))
    found = rankcoder.encoded_digests(docs, RANKS, public_tokenizers.PATTERN, chunk, overlap).collect()
    assert sorted((str(x[0]), *x[1:]) for x in found) == sorted(want)


@pytest.mark.parametrize("path", [BYTE, WORD])
@pytest.mark.parametrize("block", [encode.BLOCK_BYTES, 50])
def test_blocks_of_texts_give_the_ids_of_the_whole_texts(path, block, monkeypatch):
    monkeypatch.setattr(encode, "BLOCK_BYTES", block)
    whole, parts, said = tokenizers.Tokenizer.from_file(path), encode.PieceEncoder(path, cached=200), texts(1500, 25)
    ids = list(parts.all_ids(pa.array(said, pa.string())))
    counts = list(parts.all_counts(pa.array(said, pa.string())))
    for text, own, n in zip(said, ids, counts, strict=True):
        known = whole.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(own, "<u4").tolist() == known and n == len(known)
    assert list(parts.all_counts(pa.array(said, pa.string()).slice(5, 7))) == counts[5:12]
    assert list(parts.all_ids(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("ids", ["null", "one", "own"])
def test_pieces_without_own_ids_are_dealt_evenly_and_bins_are_counted(spark, monkeypatch, ids):
    monkeypatch.setattr(packing, "PART_ROWS", 100)
    pick = random.Random(4)
    rows = [({"null": None, "one": 7, "own": k}[ids], 0, 0, pick.randint(1, 60), k) for k in range(4000)]
    pieces = spark.createDataFrame(rows, packing.PIECES).repartition(3)
    packed, history = packing.rounds(pieces, 64)
    found = packed.collect()
    assert sorted((x.length, x.ids_crc32) for x in found) == sorted((x[3], x[4]) for x in rows)
    sizes, fill = {}, {}
    for x in found:
        sizes[x.part] = sizes.get(x.part, 0) + 1
        fill[x.part, x.bin] = fill.get((x.part, x.bin), 0) + x.length
    assert len(sizes) > 10 and max(sizes.values()) <= 200
    assert max(fill.values()) <= 64
    # The counts kept per round fall, and the last one is the true number of bins.
    assert history == sorted(history, reverse=True) and history[-1] == len(fill)
    goal = packing.lower_bound(np.bincount([x[3] for x in rows], minlength=65), 64)
    assert goal <= len(fill) <= history[0]
