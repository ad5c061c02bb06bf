"""Keyword search with blocks left unread, against scoring everything."""

import random

import pytest
from pyspark.sql import functions as F

from sheetlake.operators import bm25
from sheetlake.operators.topn import first_n

WORDS = [f"w{k}" for k in range(400)]


def corpus(seed, n, longest):
    pick = random.Random(seed)
    weights = [1 / (k + 1) for k in range(len(WORDS))]
    return [(f"d{k:04d}", " ".join(pick.choices(WORDS, weights, k=pick.randint(0, longest)))) for k in range(n)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    docs = [*corpus(1, 900, 120), *((f"e{k}", "w300 w301 w302 w303") for k in range(40)), ("none", None), ("blank", "  ")]
    path = str(tmp_path_factory.mktemp("index"))
    bm25.build_index(bm25.spread(spark.createDataFrame(docs, "id string, contents string"))).save(path, 8)
    return bm25.KeywordIndex.load(spark, path)


@pytest.fixture(scope="module")
def queries(spark):
    rows = [(k, x) for k, (_, x) in enumerate(corpus(2, 30, 60))]
    rows += [(100, "w0"), (101, "w300 w301"), (102, "nowhere"), (103, None), (104, "w399 w0 w1 w2"), (105, "w0 w0 w0 w1")]
    return spark.createDataFrame(rows, "query_id int, text string")


def best(units, k):
    ranked = first_n(units.select("query_id", "id", "units"), ["query_id"], [F.desc("units"), F.asc("id")], k)
    return sorted(map(tuple, ranked.select("query_id", "rank", "id", "units").collect()))


@pytest.mark.parametrize("k", [1, 5, 2000])
@pytest.mark.parametrize("small", [True, False])
def test_the_best_are_those_of_scoring_everything(stored, queries, k, small):
    terms = bm25.query_terms(queries)
    whole = bm25.score_documents(stored, terms, small=small)
    assert best(bm25.pruned_units(stored, terms, k, small=small).units, k) == best(whole, k)


def test_other_parameters_than_those_of_the_index(stored, queries):
    terms = bm25.query_terms(queries)
    whole = bm25.score_documents(stored, terms, k1=0.3, b=0.1)
    assert best(bm25.pruned_units(stored, terms, 5, k1=0.3, b=0.1).units, 5) == best(whole, 5)


def test_blocks_are_left_unread(stored, queries):
    terms = bm25.query_terms(queries)
    found = bm25.pruned_units(stored, terms, 3)
    late, early = (found.plan.where(x).select("query_id", "term", "block") for x in ("late", "not late"))
    rows = found.matched.join(early, ["term", "block"]).count()
    looked_up = found.viable.select("query_id", "id", "block").join(late, ["query_id", "block"])
    rows += looked_up.join(found.matched.drop("block"), ["term", "id"]).count()
    everything = terms.join(found.matched, "term").count()
    assert late.count() > 0.3 * found.plan.count()
    assert rows < 0.6 * everything
    assert found.viable.count() < 0.3 * bm25.score_documents(stored, terms).count()


def test_blocks_know_their_best_posting(stored):
    blocks = stored.postings.groupBy("term", "block").agg(F.count("*").alias("n"), F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl"))
    assert blocks.exceptAll(stored.blocks.select(blocks.columns)).isEmpty()
    assert stored.blocks.count() == blocks.count()
    assert stored.terms.exceptAll(bm25.term_stats(stored.postings)).isEmpty()
