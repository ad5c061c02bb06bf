"""Stored vector blocks against the plain search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetlake.operators import vectors, vectorstore

SCHEMA = "id string, embedding array<float>"


def rows(seed, n, dim, spread):
    pick = np.random.default_rng(seed)
    middle = 5 * pick.normal(size=(12, dim))
    found = [middle[k % 12] + spread * pick.normal(size=dim) for k in range(n)]
    for k in range(0, n - 5, 9):
        found[k + 4] = found[k]
    return [(f"v{k:05d}", x.astype(np.float32).tolist()) for k, x in enumerate(found)]


def stored(spark, monkeypatch, path, table, block=40):
    monkeypatch.setattr(vectorstore, "BLOCK_ROWS", block)
    monkeypatch.setattr(vectorstore, "HEADERS", 7)
    monkeypatch.setattr(vectorstore, "QUERIES", 5)
    vectorstore.save_blocks(table, path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("spread", [0.1, 4.0])
@pytest.mark.parametrize("k", [1, 6])
def test_equals_the_plain_search(spark, monkeypatch, tmp_path, spread, k):
    table = spark.createDataFrame(rows(1, 900, 8, spread), SCHEMA).repartition(3)
    asked = spark.createDataFrame([(n, x) for n, (_, x) in enumerate(rows(1, 24, 8, spread))], "query_id int, embedding array<float>")
    store = stored(spark, monkeypatch, str(tmp_path / "s"), table)
    assert store.agg(F.sum("n")).head()[0] == 900 and store.count() >= 900 // 80
    found = vectorstore.knn_l2_stored(store, asked, k)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, vectors.knn_l2(table, asked, k).collect()))


def test_far_blocks_are_not_reached(spark, monkeypatch, tmp_path):
    table = spark.createDataFrame(rows(2, 1200, 8, 0.1), SCHEMA)
    store = stored(spark, monkeypatch, str(tmp_path / "s"), table)
    asked = spark.createDataFrame([(n, x) for n, (_, x) in enumerate(rows(2, 12, 8, 0.1))], "query_id int, embedding array<float>")
    limits = asked.withColumn("limit", F.lit(1.0))
    pairs = vectorstore.reachable_blocks(store, limits, 8, 2, 3, "int")
    assert 0 < pairs.count() < 0.5 * 12 * store.count()


def test_one_vector_for_a_third_of_all_and_fewer_than_k(spark, monkeypatch, tmp_path):
    data = rows(3, 300, 4, 1.0)
    data = [(k, data[0][1] if n % 3 == 0 else x) for n, (k, x) in enumerate(data)]
    table = spark.createDataFrame(data, SCHEMA)
    asked = spark.createDataFrame([(1, data[0][1]), (2, [9.0] * 4), (3, [1.0]), (4, None)], "query_id int, embedding array<float>")
    store = stored(spark, monkeypatch, str(tmp_path / "s"), table, 20)
    assert store.agg(F.max("n")).head()[0] < 60
    for k in (3, 500):
        want = vectors.knn_l2(table, asked, k, skip_unsearchable=True)
        assert sorted(map(tuple, vectorstore.knn_l2_stored(store, asked, k).collect())) == sorted(map(tuple, want.collect()))


def test_nothing_stored(spark, monkeypatch, tmp_path):
    store = stored(spark, monkeypatch, str(tmp_path / "s"), spark.createDataFrame([("a", None)], SCHEMA))
    asked = spark.createDataFrame([(1, [1.0])], "query_id int, embedding array<float>")
    assert vectorstore.knn_l2_stored(store, asked).collect() == []
