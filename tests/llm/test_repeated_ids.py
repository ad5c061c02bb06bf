"""No text is lost by an id that several texts have."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from sheetlake.llm import chosenpath, toxicity
from sheetlake.llm.words import hash_words

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int = 120) -> list[str]:
    pick = random.Random(seed)
    return ["".join(pick.choice("abcdefghijk") for _ in range(pick.randint(3, 8))) for _ in range(n)]


X, Y = prose(1), prose(2)
NEAR_X, NEAR_Y = [*X[:119], "other"], [*Y[:119], "changed"]


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame([(k, " ".join(x), "en", "s", 1) for k, x in rows], COLUMNS)


def test_each_text_of_an_id_has_its_own_component(spark):
    docs = frame(spark, [(2, NEAR_X), (4, X), (4, Y), (9, NEAR_Y), (4, X)])
    found = {tuple(x) for x in chosenpath.near_duplicates(docs).select("doc_id", "component_id", "kept").collect()}
    assert found == {(2, 2, True), (4, 2, False), (4, 4, True), (9, 4, False)}


@pytest.mark.parametrize("others", [[], [(9, NEAR_Y)], [(1, NEAR_Y)]])
def test_near_copies_go_by_row(spark, others):
    docs = frame(spark, [(2, NEAR_X), (4, X), (4, Y), *others])
    left = [x.text.split() for x in chosenpath.drop_near_copies(docs).collect()]
    assert len(left) == 2
    assert sum(x in (X, NEAR_X) for x in left) == 1 and sum(x in (Y, NEAR_Y) for x in left) == 1


def labelled(spark):
    rows = [(k, ["grumble", "snarl", *prose(k)] if k % 3 == 0 else prose(k)) for k in range(20, 150)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0), 1) for k, _ in rows], "doc_id long, toxic int, quality int")
    return rows, labels


def test_toxic_texts_go_by_row(spark):
    rows, labels = labelled(spark)
    rows += [(500, ["grumble", "snarl", *X]), (500, Y), (None, ["grumble", "snarl", *Y]), (None, X)]
    left = [(x.doc_id, x.text.split()) for x in toxicity.drop_toxic(frame(spark, rows), labels).collect()]
    assert [x for x in left if x[0] in (500, None)] == [(500, Y), (None, X)]


def test_the_pipeline_keeps_one_of_each(spark, tmp_path):
    rows, labels = labelled(spark)
    rows += [(2, NEAR_X), (4, X), (4, Y), (9, NEAR_Y), (4, Y)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = frame(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
    left = [x.text for x in docs.where("doc_id in (2, 4, 9)").collect()]
    assert len(left) == 2
    assert sum(x.split()[:100] == X[:100] for x in left) == 1 and sum(x.split()[:100] == Y[:100] for x in left) == 1


def test_the_sample_does_not_depend_on_the_layout(spark):
    docs = frame(spark, [(7, X), (7, Y), (7, X), (8, X)])
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, toxic int")
    found = {
        tuple((x.doc_id, x.n, bytes(x.terms)) for x in toxicity.bounded_examples(d, labels, 10, 10_000).orderBy("doc_id").collect())
        for d in (docs, docs.repartition(3), docs.orderBy("text"))
    }
    assert len(found) == 1 and len(next(iter(found))) == 2
    assert toxicity.bounded_examples(docs, labels, 10, 130).count() == 1


def test_words_that_a_polynomial_confuses_have_hashes_of_their_own():
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    a, b = hash_words(word.encode())[1], hash_words(other.encode())[1]
    assert a[0] != b[0]
    assert hash_words(f"x {word} y".encode())[1][1] == a[0]
