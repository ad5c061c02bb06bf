"""Hard negatives against a full comparison, and the pruning they rest on."""

from __future__ import annotations

import math

import numpy as np
import pytest

from sheetlake.llm import hardnegatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, score string, slot int, _block string"


def vectors(seed: int, n: int, dim: int, spread: float) -> list[tuple]:
    """Vectors around a few directions, of lengths from a wide range, with equal ones among them."""
    pick = np.random.default_rng(seed)
    middle = pick.normal(size=(6, dim))
    rows = []
    for k in range(n):
        x = middle[k % 6] + spread * pick.normal(size=dim)
        x = x / np.linalg.norm(x) * pick.choice([0.2, 1.0, 1.1, 3.0, 20.0])
        rows.append((k, x.tolist(), int(pick.integers(0, 10)), "clash", 1, "x"))
    for k in range(0, n - 7, 11):
        rows[k + 7] = (rows[k + 7][0], rows[k][1], *rows[k + 7][2:])
    return rows


def brute(rows: list[tuple]) -> list[tuple]:
    used = {}
    for vec_id, vector, label, *_ in rows:
        good = vec_id is not None and label is not None and vector and all(x is not None and math.isfinite(x) for x in vector)
        if good:
            label = (label + 1) % 10 if vec_id % 7 == 0 else label
            used[vec_id, label, tuple(vector)] = (vec_id, label, [math.floor(256 * x) for x in vector])
    used = list(used.values())
    out = []
    for anchor in (x for x in used if x[0] % 100 == 0):
        others = [
            (-sum(a * b for a, b in zip(anchor[2], x[2])), x[0], x[1])
            for x in used
            if x is not anchor and len(x[2]) == len(anchor[2])
        ]
        others.sort()
        for p, positive, _ in [x for x in others if x[2] == anchor[1]][:5]:
            fits = [x for x in others if x[2] != anchor[1] and 80 * -p <= 100 * -x[0] <= 100 * -p]
            out += [(anchor[0], positive, k + 1, x[1], -p, -x[0]) for k, x in enumerate(fits[:5])]
    return sorted(out)


def run(spark, rows: list[tuple]) -> list[tuple]:
    frame = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert frame.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equals_a_full_comparison(spark, monkeypatch, spread):
    monkeypatch.setattr(hn, "BUCKET_ROWS", 64)
    monkeypatch.setattr(hn, "GROUP_ROWS", 300)
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 5)
    rows = vectors(1, 1500, 12, spread)
    found = run(spark, rows)
    assert found == brute(rows) and found


def test_rows_that_take_no_part_and_rows_that_repeat(spark):
    rows = vectors(2, 260, 5, 0.3)
    rows += [(300, None, 1, None, None, None), (301, [1.0] * 5, None, None, None, None), (None, [1.0] * 5, 2, "", 0, "")]
    rows += [(302, [1.0, None, 1.0, 1.0, 1.0], 1, "", 0, ""), (400, [], 1, "", 0, ""), (303, [float("nan")] * 5, 3, "", 0, "")]
    rows += [(304, [float("inf")] * 5, 3, "", 0, ""), (500, [0.0] * 5, 3, "", 0, ""), (501, [0.0] * 5, 3, "", 0, "")]
    rows += [(600, [1.0, 2.0], 3, "", 0, ""), (601, [1.0, 2.0], 3, "", 0, ""), (602, [1.0, 1.9], 4, "", 0, "")]
    rows += [rows[100], rows[7], rows[8]]
    found = run(spark, rows)
    assert found == brute(rows)
    assert any(x[0] == 600 for x in found) and any(x[0] == 500 and x[4] == 0 for x in found)


def test_a_vector_that_a_third_of_the_rows_share(spark):
    rows = vectors(3, 900, 6, 0.5)
    rows = [(k, rows[0][1] if k % 3 == 0 else x, *rest) for k, x, *rest in rows]
    assert run(spark, rows) == brute(rows)


def test_one_label_few_rows_and_none(spark):
    rows = [(k, [1.0, float(k)], 1, "", 0, "") for k in (100, 101, 102)]
    assert run(spark, rows) == [] and run(spark, []) == []
    rows.append((103, [1.0, 99.0], 2, "", 0, ""))
    assert run(spark, rows) == brute(rows) != []


def held(rows: np.ndarray) -> tuple:
    ids = np.arange(len(rows), dtype="<i8").tobytes()
    lengths = np.sqrt((rows**2).sum(axis=1))
    order = np.argsort(rows / np.maximum(lengths, 1e-300)[:, None], axis=0, kind="stable").T.astype("<i2").tobytes()
    return rows.shape[1], ids, ids, ids, "<f8", rows.astype("<f8").tobytes(), order


def test_pruning_keeps_every_row_that_reaches_the_score():
    pick = np.random.default_rng(5)
    for spread, some in ((0.02, True), (0.4, False), (3.0, False)):
        middle = pick.normal(size=(8, 16))
        both = middle[pick.integers(0, 8, 640)] + spread * pick.normal(size=(640, 16))
        both = np.floor(2560 * both / np.linalg.norm(both, axis=1)[:, None])
        rows, asked = both[:600], both[600:]
        bucket, anchors = hn.Bucket(*held(rows)), hn.Vectors(*held(asked))
        scores = hn.products(anchors.values, bucket.values)
        for rank in (3, 30, 300):
            least = -np.sort(-scores, axis=1)[:, rank].astype(np.float64)
            found, cut = hn.candidates(bucket, anchors, hn._focus(anchors), least)
            for k, kept in enumerate(found):
                if kept is not None:
                    assert set(np.flatnonzero(scores[k] >= least[k])) <= set(kept.tolist())
            if some and rank == 3:
                assert cut == 40 and np.mean([len(x) for x in found]) < 200


def test_a_bucket_of_short_vectors_is_skipped():
    bucket, anchors = hn.Bucket(*held(np.full((9, 3), 2.0))), hn.Vectors(*held(np.full((2, 3), 5.0)))
    found, cut = hn.candidates(bucket, anchors, hn._focus(anchors), np.array([31.0, 30.0]))
    assert cut == 1 and len(found[0]) == 0 and (found[1] is None or len(found[1]) == 9)


def test_products_are_exact_for_large_components():
    left, right = np.array([[2.0**31 + 1, 3.0]]), np.array([[2.0**30 + 1, 5.0]])
    assert hn.products(left, right).tolist() == [[(2**31 + 1) * (2**30 + 1) + 15]]
