"""Token counts against the library on whole texts, and what the cache is asked for."""

from __future__ import annotations

import random

import public_tokenizers
import pytest

from sheetlake.llm import tokencounts

tokenizers = pytest.importorskip("tokenizers")

BYTE = str(public_tokenizers.path("byte_bpe_50k.json"))
WORD = str(public_tokenizers.path("word_bpe_49k.json"))
SCHEMA = "doc_id long, text string, n_tokens string, digest int, _salt string"


def rows() -> list[tuple]:
    pick = random.Random(3)
    parts = ["the ", "Word", " ", "\n", "é", "<|endoftext|>", "中文", "🙂", "don't ", "　", "12 "]
    said = [None, "", " ", "same", "same", "x " * 700_000, "unbroken" * 20_000]
    said += ["".join(pick.choices(parts, k=pick.randint(1, 900))) for _ in range(60)]
    found = [(k, x, "clash", 1, "y") for k, x in enumerate(said)]
    return found + [(None, "no id", None, None, None), (3, "same", None, None, None), (3, "another", "c", 2, "z"), found[9]]


def brute(path: str, found: list[tuple]) -> list[tuple]:
    whole = tokenizers.Tokenizer.from_file(path)
    out = []
    for doc_id, text, *_ in found:
        n = len(whole.encode(text or "", add_special_tokens=False).ids)
        out.append((doc_id, len((text or "").encode()), n, n > 1024))
    return sorted(out, key=str)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_counts_are_those_of_the_library(spark, path):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    found = sorted(map(tuple, tokencounts.token_counts(docs, path).collect()), key=str)
    assert found == brute(path, rows())
    assert any(x[3] for x in found) and not all(x[3] for x in found)


def test_only_missing_texts_are_encoded(spark, tmp_path, monkeypatch):
    cache = str(tmp_path / "cache")
    docs = spark.createDataFrame(rows(), SCHEMA)
    encoded = []

    def run(frame, path=BYTE):
        before = tokencounts.stored_counts(spark, f"{cache}/{tokencounts.tokenizer_version(path)}")
        before = before.count() if before is not None else 0
        found = tokencounts.token_counts(frame, path, cache).collect()
        stored = spark.read.parquet(f"{cache}/{tokencounts.tokenizer_version(path)}")
        assert stored.count() == stored.select("digest").distinct().count()
        encoded.append(stored.count() - before)
        return sorted(map(tuple, found), key=str)

    assert run(docs.limit(20)) == brute(BYTE, rows()[:20])
    assert run(docs) == brute(BYTE, rows())
    assert run(docs) == brute(BYTE, rows())
    # Null and empty are one text; another tokenizer shares nothing.
    distinct = len({x[1] or "" for x in rows()})
    assert encoded[0] + encoded[1] == distinct and encoded[0] > 0 and encoded[2] == 0
    run(docs, WORD)
    assert encoded[3] == distinct


def test_entries_that_were_appended_twice_count_once(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = spark.createDataFrame(rows()[:12], SCHEMA)
    tokencounts.token_counts(docs, BYTE, cache).collect()
    folder = f"{cache}/{tokencounts.tokenizer_version(BYTE)}"
    stored = spark.createDataFrame(spark.read.parquet(folder).collect(), tokencounts.CACHED)
    stored.write.mode("append").parquet(folder)
    found = tokencounts.token_counts(docs, BYTE, cache).collect()
    assert sorted(map(tuple, found), key=str) == brute(BYTE, rows()[:12])


def test_an_empty_table_gives_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert tokencounts.token_counts(empty, BYTE, str(tmp_path / "c")).collect() == []
    assert tokencounts.token_counts(empty, BYTE, str(tmp_path / "c")).collect() == []


def test_a_text_that_a_third_of_the_rows_share(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot text', concat('text ', id)) AS text")
    found = {x.doc_id: x.n_tokens for x in tokencounts.token_counts(docs, BYTE).collect()}
    whole = tokenizers.Tokenizer.from_file(BYTE)
    assert len(found) == 3000 and found[0] == found[2997] == len(whole.encode("hot text").ids)
    assert found[1] == len(whole.encode("text 1").ids)
