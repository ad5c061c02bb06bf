"""The corpus pipeline, stage by stage, on planted cases."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from sheetlake.llm import spans
from sheetlake.session import written

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder of tables with planted toxic documents, copies, near copies and a repeated passage."""
    pick = random.Random(1)

    def prose(n: int) -> str:
        words = ["".join(pick.choice("abcdefghijk") for _ in range(pick.randint(2, 7))) for _ in range(n)]
        return " ".join(x + "." if k % 9 == 8 else x for k, x in enumerate(words))

    texts = {k: prose(120) for k in range(200)}
    for k in range(0, 60, 3):
        texts[k] = "grumble snarl hiss " + texts[k]
    texts[100] = texts[101].upper()
    said = texts[103].split()
    texts[104] = " ".join([*said[:60], "changed", *said[61:]])
    passage = prose(60) + "."
    texts[110], texts[111] = f"{prose(50)}. {passage}", f"{prose(50)}. {passage}"
    texts[120], texts[121] = None, ""
    rows = [(k, x, "en", "s", len(x or "")) for k, x in texts.items()] + [(None, prose(80), None, None, None)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    labels = [(k, int(k < 60 and k % 3 == 0), 1) for k in range(200)]
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    return path, texts, passage


def test_every_stage_decides(spark, folder):
    path, texts, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept, after = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, after, path), name)
        kept[name] = after.collect()
        if name != "packing":
            assert after.columns == docs.columns
    ids = {name: {x.doc_id for x in rows} for name, rows in kept.items()}
    toxic = {k for k in range(0, 60, 3)}
    assert ids["toxicity"] == set(texts) - toxic | {None}
    assert ids["toxicity"] - ids["exact_dedup"] == {100, 120}
    assert ids["exact_dedup"] - ids["near_dedup"] == {104}
    assert ids["substring_dedup"] == ids["near_dedup"] == ids["packing"]
    cut = {x.doc_id: x for x in kept["substring_dedup"]}
    assert passage in cut[110].text and passage not in cut[111].text
    assert len(cut[111].text.split()) <= 60 and cut[111].n_chars == len(cut[111].text)
    assert all(cut[k].text == texts[k] for k in ids["near_dedup"] - {111, None})
    assert {x.doc_id for x in kept["packing"]} == {x.doc_id for x in corpus_pipeline.run(spark, path).collect()}


def test_no_documents(spark, folder):
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder[0]).count() == 0


def test_columns_of_any_name_pass(spark, folder):
    rows = [(1, "a b c d e f g", "en", "s", 13, "u", "v", "w"), (2, "a b c d e f g", "en", "s", 13, "u", "v", "w")]
    docs = spark.createDataFrame(rows, f"{COLUMNS}, kept string, n_removed string, _covered string")
    for name, stage in corpus_pipeline.STAGES[:4]:
        found = stage(spark, docs, folder[0])
        assert found.columns == docs.columns
        assert found.count() == {"exact_dedup": 1, "near_dedup": 1}.get(name, 2)
    assert spans.without_repeats(docs).count() == 2
