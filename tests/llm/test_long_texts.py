"""Texts of more than a megabyte, end to end."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from sheetlake.llm import language, packing, quality, rankcoder, spans, toxicity, wavelet
from sheetlake.llm.words import BLOCK_BYTES

tokenizers = pytest.importorskip("tokenizers")

BYTE = str(public_tokenizers.path("byte_bpe_50k.json"))
WORD = str(public_tokenizers.path("word_bpe_49k.json"))
RANKS = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    words = ["".join(pick.choice("abcdefghijk") for _ in range(pick.randint(2, 8))) for _ in range(2000)]
    return " ".join(x + "." if k % 11 == 10 else x for k, x in enumerate(pick.choices(words, k=n)))


LONG = prose(1, 300_000)
TEXTS = {0: prose(2, 90), 1: LONG, 2: "snarl grumble " + prose(3, 60), 3: prose(4, 70), 4: "", 5: None, 6: LONG[:-200] + " the end"}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, x, "aa" if k % 2 else "bb", "clash", 1) for k, x in TEXTS.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens string, ids int").repartition(2)


def test_they_are_long():
    assert len(LONG) > BLOCK_BYTES


def test_shards_and_packing(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    wavelet.write_token_shards(docs, path, BYTE, 50_257)
    whole = tokenizers.Tokenizer.from_file(BYTE)
    ids = {k: np.array([*whole.encode(x or "").ids, 0], "<u4") for k, x in TEXTS.items()}
    for x in wavelet.token_digests(spark, path).collect():
        assert (x.n_tokens, x.ids_crc32) == (len(ids[x.doc_id]), zlib.crc32(ids[x.doc_id].tobytes()))
    found = packing.packed_sequences(docs, WORD).collect()
    whole = tokenizers.Tokenizer.from_file(WORD)
    for k, text in TEXTS.items():
        own = sorted((x for x in found if x.doc_id == k), key=lambda x: x.piece)
        assert sum(x.length for x in own) == len(whole.encode(text or "", add_special_tokens=False).ids) + 1
        assert all(x.length == packing.SEQUENCE for x in own[:-1])


def test_rank_coding_with_clashing_names(docs):
    found = {x.doc_id: x for x in rankcoder.encoded_digests(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert set(found) == set(TEXTS) and found[4].n_tokens == found[5].n_tokens == 0
    assert found[1].n_tokens > 100_000 and found[1].ids_sha256 != found[6].ids_sha256


def test_models(spark, docs):
    labels = spark.createDataFrame([(k, int(k == 2), int(k != 2)) for k in TEXTS], "doc_id long, toxic int, quality int")
    assert {x.doc_id for x in language.languages(docs).collect()} == set(TEXTS)
    scored = toxicity.toxicity(docs, labels).collect()
    assert {x.doc_id for x in scored} == set(TEXTS) and all(0 <= x.score <= 1 for x in scored)
    counted = {x.doc_id: x for x in quality.quality(docs, labels).collect()}
    assert counted[1].n_words == len(LONG.split()) and counted[1].word_chars == sum(map(len, LONG.split()))


def test_a_long_copy_is_cut(docs):
    cut = {x.doc_id: x for x in spans.without_repeats(docs).collect()}
    assert cut[1].text == LONG and cut[0].text == TEXTS[0] and cut[5].text is None
    assert len(cut[6].text) < 1000
    assert cut[6].text.endswith("the end")


def test_equal_neighbours_go_by_row():
    one = (np.array([1, 2]), np.array([0.6, 0.8]))
    index = toxicity.Index([30, 10, 20], np.array([1, 0, 1]), [one, one, one], 4)
    rows, cosines = index.nearest(*one, 2)
    assert index.ids[rows].tolist() == [10, 20] and np.allclose(cosines, 1)
