import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetlake.functions import fixed, tokens
from sheetlake.operators import bm25, corpus, hybrid, sizes, vectors
from sheetlake.operators.ordered import running_total
from sheetlake.plans import answer, tables
from sheetlake.plans.index import index_documents


# --- documents -------------------------------------------------------------------
def clean_rows(spark):
    columns = "year, business_id, concept, block, item_index, detail, value, original_column_name"
    rows = [
        ("2014", "1-2-3", "c", None, None, "名", "橋", "b"),
        ("2014", "1-2-3", "c", None, None, "額", "5", "a"),
        ("2014", "1-2-3", "c", None, None, "額", "4", "a"),
        ("2014", "1-2-3", "c", None, None, None, "skipped", "a"),
        ("2015", "1-2-3", "c", None, None, "", "x", "a"),
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} STRING" for c in columns.split(", ")))


def test_build_documents(spark):
    docs = {r.id: r.contents for r in corpus.build_documents(clean_rows(spark)).collect()}
    assert docs == {"2014-1-2-3": "額: 4。 額: 5。 名: 橋", "2015-1-2-3": ": x"}


@pytest.mark.parametrize("limit", [10, 64, 1000])
def test_document_parts_of_a_hot_record(spark, limit):
    rows = spark.range(600).selectExpr(
        "'2014' AS year", "IF(id % 3 = 0, 'hot', string(id % 40)) AS business_id", "'c' AS concept",
        "string(null) AS block", "string(null) AS item_index", "IF(id = 7, null, 'd') AS detail",
        "IF(id % 2 = 0, 'same', string(id)) AS value", "string(id % 4) AS original_column_name",
    )
    whole = {r.id: r.contents for r in corpus.build_documents(rows).collect()}
    parts = {}
    for r in corpus.build_document_parts(rows, limit).collect():
        number = int(r.id.split("_chunk_")[1]) if "_chunk_" in r.id else 0
        parts.setdefault(r.parent_id, {})[number] = r.contents
        assert len(r.contents.encode()) <= limit + 16
    assert {i: "。 ".join(p[n] for n in sorted(p)) for i, p in parts.items()} == whole
    assert limit > 100 or len(parts["2014-hot"]) > 10


def test_running_total_is_exact(spark):
    frame = spark.range(1000).selectExpr("IF(id % 3 = 0, 'hot', 'cold') AS k", "id % 7 AS o", "id + 1 AS n")
    rows = running_total(frame, ["k"], ["o"], F.col("n")).collect()
    for key in ("hot", "cold"):
        mine = sorted((r.total, r.o, r.n) for r in rows if r.k == key)
        assert [o for _, o, _ in mine] == sorted(o for _, o, _ in mine)
        total = 0
        for got, _, n in mine:
            total += n
            assert got == total


def greedy_chunks(contents: str, limit: int) -> list[str]:
    """Brute force on bytes, one cut after the other."""
    raw, pieces, start = contents.encode(), [], 0
    while start < len(raw):
        window = raw[start:start + limit]
        if start + limit < len(raw):
            space = window.rfind(b" ")
            if space > 0:
                window = window[:space]
            else:
                window = window.decode(errors="ignore").encode()
        pieces.append(window.decode().strip())
        start += len(window)
    return pieces


@pytest.mark.parametrize("limit", [4, 7, 16, 64])
def test_chunks_match_brute_force(spark, limit):
    rng = random.Random(limit)
    alphabet = ["a", "bb", "ccc", "é", "日本", "漢", "x" * 9, "ü" * 5]
    texts = [" ".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(60)]
    texts += ["a" * limit, "a" * (limit + 1), "日" * 9, "a b  c d e f g h", ""]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id STRING, contents STRING")
    rows = corpus.chunk_docs(docs, limit).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.parent_id, r.chunk_no or 0)):
        got.setdefault(r.parent_id, []).append(r.contents)
        assert len(r.contents.encode()) <= limit or r.chunk_no is None
        assert r.id == (r.parent_id if r.chunk_no is None else f"{r.parent_id}_chunk_{r.chunk_no}")
    for i, t in enumerate(texts):
        want = [t] if len(t.encode()) <= limit else greedy_chunks(t, limit)
        assert got[str(i)] == want, t


def test_default_chunk_budget(spark):
    docs = spark.createDataFrame([("a", "x y")], "id STRING, contents STRING")
    assert [tuple(r) for r in corpus.chunk_docs(docs).collect()] == [("a", "a", None, "x y")]
    long = spark.range(1).select(F.lit("b").alias("id"), F.repeat(F.lit("abc "), 3_000_000).alias("contents"))
    sizes_ = [r[0] for r in corpus.chunk_docs(long).select(F.octet_length("contents")).collect()]
    assert len(sizes_) == 2 and max(sizes_) <= fixed.CHUNK_BYTES


def test_corpus_check(spark):
    docs = spark.createDataFrame([(f"{i:02d}", f"text {i}") for i in range(10)], "id STRING, contents STRING")
    rows = corpus.corpus_check(docs, 3).collect()
    kinds = Counter(r.sample_kind for r in rows)
    assert kinds == {"first": 3, "last": 3, "random": 3} and {r.total_docs for r in rows} == {10}
    assert {r.id for r in rows if r.sample_kind == "last"} == {"07", "08", "09"}
    assert rows[0].preview == "text 0..."
    again = corpus.corpus_check(docs, 3, seed=1).collect()
    assert {r.id for r in again if r.sample_kind == "random"} != {r.id for r in rows if r.sample_kind == "random"}
    few = corpus.corpus_check(docs.filter("id < '03'"), 3).collect()
    assert Counter(r.sample_kind for r in few) == {"first": 3, "last": 3}


# --- BM25 ------------------------------------------------------------------------
TEXTS = {
    "a": "red fish blue fish", "b": "one fish", "c": "blue sky and blue sea", "d": "nothing here", "e": "", "f": "one fish",
}
QUESTIONS = [(1, "blue fish"), (2, "fish fish one"), (3, "unknown"), (4, ""), (5, "Blue")]


def brute_bm25(texts, questions, k, k1=0.9, b=0.4):
    bags = {i: t.split() for i, t in texts.items()}
    filled = [w for w in bags.values() if w]
    n, average = len(filled), sum(map(len, filled)) / len(filled)
    hits = []
    for q, text in questions:
        scores = {}
        for i, bag in bags.items():
            tf, score = Counter(bag), 0.0
            for term, count in Counter(text.split()).items():
                if tf[term]:
                    df = sum(term in w for w in bags.values())
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    score += count * idf * tf[term] / (tf[term] + k1 * (1 - b + b * len(bag) / average))
            if score:
                scores[i] = score
        best = sorted(scores.items(), key=lambda s: (-round(s[1], 9), s[0]))[:k]
        hits += [(q, r, i, round(s, 6)) for r, (i, s) in enumerate(best, start=1)]
    return sorted(hits)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "id STRING, contents STRING")


@pytest.fixture(scope="module")
def questions(spark):
    return spark.createDataFrame(QUESTIONS, "query_id BIGINT, text STRING")


def rows_of(hits):
    return sorted((r.query_id, r.rank, r.id, round(r.score, 6)) for r in hits.collect())


@pytest.mark.parametrize("small", [True, False])
def test_bm25_matches_brute_force(docs, questions, small):
    index = bm25.build_index(docs)
    want = brute_bm25(TEXTS, QUESTIONS, 2)
    assert rows_of(bm25.bm25_search(index, questions, 2, small=small)) == want
    assert rows_of(answer.search_documents(docs, questions, 2)) == want
    limited = bm25.build_index(docs, vocabulary=bm25.query_terms(questions), small=small)
    assert rows_of(bm25.bm25_search(limited, questions, 2, small=small)) == want


def test_index_tables(docs):
    index = bm25.build_index(docs)
    assert {(r.term, r.df) for r in index.terms.filter("term in ('fish', 'blue')").collect()} == {("fish", 3), ("blue", 2)}
    row = index.corpus.head()
    assert (row.n_docs, row.avg_dl) == (5, 15 / 5)


def test_stored_index(spark, docs, questions, tmp_path):
    bm25.build_index(docs).save(str(tmp_path / "index"))
    stored = bm25.KeywordIndex.load(spark, str(tmp_path / "index"))
    assert rows_of(bm25.bm25_search(stored, questions, 2)) == brute_bm25(TEXTS, QUESTIONS, 2)
    plan = bm25.score_documents(stored, bm25.query_terms(questions))._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "tf#" in x)
    assert "PartitionFilters: [bucket" in scan or "PartitionFilters: [isnotnull(bucket" in scan or "bucket#" in scan.split("PartitionFilters")[1].split("]")[0]


def test_query_index_has_the_figures_of_the_whole_corpus(docs, questions):
    chunks = docs.withColumn("parent_id", F.col("id"))
    terms = bm25.query_terms(questions)
    index, whole = bm25.build_query_index(chunks, terms, small=True), bm25.build_index(docs)
    assert index.corpus.head() == whole.corpus.head()
    assert rows_of(bm25.bm25_search(index, questions, 2, small=True)) == brute_bm25(TEXTS, QUESTIONS, 2)
    known = {r.term for r in terms.select("term").distinct().collect()}
    assert {tuple(r) for r in index.terms.collect()} == {tuple(r) for r in whole.terms.collect() if r.term in known}


def test_chunks_are_ranked_before_their_parent_is_looked_up(spark):
    docs = spark.createDataFrame([("long", "fish fish aa bb fish"), ("other", "cc")], "id STRING, contents STRING")
    queries = spark.createDataFrame([(1, "fish")], "query_id BIGINT, text STRING")
    hits = bm25.bm25_search(index_documents(docs, 10), queries, 5).collect()
    assert [(h.id, h.chunk_id) for h in sorted(hits, key=lambda h: h.rank)] == [
        ("long", "long_chunk_0"), ("long", "long_chunk_2"),
    ]


def test_search_shuffles_texts_once_and_then_only_the_best(docs, questions):
    index = bm25.build_index(docs, tokens.words, bm25.query_terms(questions), True)
    plan = bm25.score_documents(index, bm25.query_terms(questions), small=True)
    text = plan._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    main = text.split("BroadcastHashJoin")[0]
    assert "Exchange" not in main


# --- vectors ---------------------------------------------------------------------
def brute_knn(points, queries, k):
    hits = []
    for q, x in queries:
        near = sorted((float(((np.array(p) - np.array(x)) ** 2).sum()), i) for i, p in points)[:k]
        hits += [(q, r, i, round(d, 9)) for r, (d, i) in enumerate(near, start=1)]
    return sorted(hits)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(0)
    rows = [(f"v{i:03d}", [float(x) for x in np.float32(rng.normal(size=4))]) for i in range(200)]
    return rows + [(f"w{i:03d}", [1.0, 0.0, 0.0, 0.0]) for i in range(100)]


def knn_rows(frame):
    return sorted((r.query_id, r.rank, r.id, round(r.distance, 9)) for r in frame.collect())


@pytest.mark.parametrize("most", [4_000_000, 8])
def test_knn_matches_brute_force(spark, points, monkeypatch, most):
    monkeypatch.setattr(vectors, "MAX_QUERY_VALUES", most)
    monkeypatch.setattr(vectors, "QUERY_BLOCK_BYTES", 3 * 8 * 4)
    monkeypatch.setattr(vectors, "VECTOR_BLOCK_BYTES", 64 * 8 * 4)
    monkeypatch.setattr(vectors, "TILE_BYTES", 2048)
    queries = [(i, p) for i, (_, p) in enumerate(points[:6])] + [(9, [1.0, 0.0, 0.0, 0.0])]
    store = spark.createDataFrame(points, "id STRING, embedding ARRAY<FLOAT>").repartition(3)
    asked = spark.createDataFrame(queries, "query_id BIGINT, embedding ARRAY<FLOAT>")
    hits = vectors.knn_l2(store, asked, 4)
    rows = knn_rows(hits)
    assert rows == brute_knn(points, queries, 4)
    assert [r for r in rows if r[0] == 9][0][2:] == ("w000", 0.0)


def test_a_chunk_holds_a_character(docs):
    with pytest.raises(ValueError, match="at least"):
        corpus.chunk_docs(docs, 3)


def test_tiles_stay_inside_the_budget():
    for dimension in (1, 64, 1_000, 100_000):
        queries, some = vectors.tile_sizes(dimension)
        assert queries >= 1 and some >= 1
        assert 8 * (queries * some + (queries + some) * dimension) <= vectors.TILE_BYTES
    rng = np.random.default_rng(1)
    asked, stored = rng.normal(size=(60_000, 64)), rng.normal(size=(300, 64))
    search = vectors._Nearest(asked, 2)
    search.add(np.arange(300), stored)
    q, ids, distances = search.rows()
    assert len(q) == 120_000 and max(len(t) for t in search.tiles) <= vectors.tile_sizes(64)[0]
    exact = ((stored - asked[59_999]) ** 2).sum(axis=1)
    assert ids[q == 59_999].tolist() == np.argsort(exact)[:2].tolist()


def test_knn_with_fewer_vectors_than_k_and_bad_vectors(spark):
    store = spark.createDataFrame(
        [(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, None), (4, [1.0]), (5, [float("nan"), 0.0])], "id BIGINT, embedding ARRAY<FLOAT>"
    )
    asked = spark.createDataFrame([(7, [0.0, 0.0]), (8, None)], "query_id BIGINT, embedding ARRAY<FLOAT>")
    for dimension in (None, 2):
        with pytest.raises(ValueError, match="unsearchable"):
            vectors.knn_l2(store, asked, 5, dimension)
    listed = {tuple(r) for r in vectors.unsearchable(store, 2).collect()}
    assert listed == {(3, "missing"), (4, "length"), (5, "holes")}
    assert knn_rows(vectors.knn_l2(store, asked, 5, skip_unsearchable=True)) == [(7, 1, 1, 0.0), (7, 2, 2, 25.0)]
    check = {r.dimension: (r.n_vectors, r.n_null, r.n_with_holes, r.is_valid) for r in vectors.vector_store_check(store).collect()}
    assert check == {2: (3, 0, 1, True), -1: (1, 1, 0, False), 1: (1, 0, 0, False)}
    none = vectors.knn_l2(store, asked.filter("query_id = 8"), 5, skip_unsearchable=True)
    assert none.columns == ["query_id", "rank", "id", "distance"] and none.count() == 0


# --- hybrid ----------------------------------------------------------------------
def test_merge_contents_and_prompt(spark):
    keyword = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "a")], "query_id BIGINT, rank INT, id STRING")
    vector = spark.createDataFrame([(1, 1, "b"), (1, 2, "c"), (2, 1, "a")], "query_id BIGINT, rank INT, id STRING")
    docs = spark.createDataFrame([("a", "A"), ("b", "B{query}")], "id STRING, contents STRING")
    for few in (True, False):
        hits = hybrid.hybrid_search(keyword, vector, docs, few)
        rows = sorted((r.query_id, r.position, r.id, r.leg, r.rank, r.contents) for r in hits.collect())
        assert rows == [
            (1, 1, "a", "keyword", 1, "A"), (1, 2, "b", "keyword", 2, "B{query}"), (1, 3, "c", "vector", 2, ""),
            (2, 1, "a", "vector", 1, "A"),
        ]
    queries = spark.createDataFrame([(1, "why?"), (3, "no hits")], "query_id BIGINT, text STRING")
    prompts = {r.query_id: r.prompt for r in hybrid.assemble_prompt(queries, hits).collect()}
    want = fixed.PROMPT_TEMPLATE.replace("{query}", "why?").replace("{context}", "A\n\n---\n\nB{query}\n\n---\n\n")
    assert prompts[1] == want
    assert prompts[3] == fixed.PROMPT_TEMPLATE.replace("{context}", "").replace("{query}", "no hits")
    assert hybrid.answer_preview(hits, 1).filter("id = 'b'").head().contents == "B..."


def test_whole_answer(spark, docs):
    rng = np.random.default_rng(1)
    store = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=3)]) for i in TEXTS], "id STRING, embedding ARRAY<FLOAT>")
    queries = spark.createDataFrame([(1, "blue fish", [0.0, 0.0, 0.0])], "query_id BIGINT, text STRING, embedding ARRAY<FLOAT>")
    index = bm25.build_index(docs)
    hits = answer.search(index, store, docs, queries, 2).collect()
    assert len({h.id for h in hits}) == len(hits) <= 4
    assert "blue fish" in answer.prompts(index, store, docs, queries, 2).head().prompt


def test_few_hits(spark, monkeypatch):
    queries = spark.range(3).withColumnRenamed("id", "query_id")
    assert hybrid.few_hits(queries, 5)
    monkeypatch.setattr(hybrid, "MAX_ROWS", 20)
    assert not hybrid.few_hits(queries, 5)


def test_size_check_looks_at_few_rows(spark):
    assert sizes.is_small(spark.range(10), 10) and not sizes.is_small(spark.range(11), 10)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 100).alias("t"))
    assert not sizes.is_small(wide, 100, 1000) and sizes.is_small(wide, 100, 2000)


def test_more_text_makes_more_tasks(spark):
    docs = spark.range(100).select(F.col("id").cast("string").alias("id"), F.repeat(F.lit("abcdefg "), 1 << 17).alias("contents"))
    for placed in (bm25.spread(docs), tables.spread(docs), index_documents(docs).postings):
        assert placed.rdd.getNumPartitions() >= 100 * 2**20 / sizes.TASK_BYTES > 4
    assert sorted(x.id for x in bm25.spread(docs.where("id < 5")).select("id").collect()) == list("01234")
    assert bm25.spread(docs.limit(0)).count() == 0


def test_only_scores_that_can_be_among_the_best_leave_their_task(spark):
    pick = random.Random(6)
    rows = [(q, f"d{d:04d}", pick.randint(1, 400)) for q in range(3) for d in range(3000 if q else 20)]
    scored = spark.createDataFrame(rows, "query_id int, id string, units bigint")
    queries = spark.createDataFrame([(q,) for q in range(4)], "query_id int")
    kept = {tuple(x) for x in bm25.reaching(scored, queries, 5).collect()}
    for q in range(3):
        mine = sorted((x for x in rows if x[0] == q), key=lambda x: (-x[2], x[1]))
        assert {x for x in mine if x[2] >= mine[4][2]} <= kept
        assert q == 0 or sum(x[0] == q for x in kept) < 1500


def test_scores_are_added_up_in_tasks_of_bounded_size(spark, docs, questions, monkeypatch):
    monkeypatch.setattr(bm25, "TASK_MATCHES", 1)
    index = bm25.build_query_index(docs.withColumn("parent_id", F.col("id")), bm25.query_terms(questions), small=True)
    matches = bm25.query_terms(questions).join(index.terms, "term").agg(F.sum("df")).head()[0]
    assert index.postings.rdd.getNumPartitions() == matches > 4
    assert rows_of(bm25.bm25_search(index, questions, 2, small=True)) == brute_bm25(TEXTS, QUESTIONS, 2)
