"""Large groups of near copies: comparing them costs in proportion to their rows, and nothing is missed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sheetlake.llm import alike, chosenpath, shingles
from sheetlake.llm.ship import ship


def family(pick: np.random.Generator, n: int, size: int, other: float) -> list[np.ndarray]:
    """Sets that share most of their members with one base."""
    base = pick.integers(1, 1 << 62, size, dtype=np.uint64)
    rows = []
    for _ in range(n):
        own = base.copy()
        own[pick.random(size) < pick.random() * other] = 0
        fresh = pick.integers(1, 1 << 62, int((own == 0).sum()), dtype=np.uint64)
        rows.append(np.unique(np.concatenate([own[own > 0], fresh])))
    return rows


def least_labels(n: int, pairs: list[tuple[int, int]]) -> list[int]:
    up = list(range(n))

    def find(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return [find(x) for x in range(n)]


def matrix(sets: list[np.ndarray]) -> np.ndarray:
    return np.stack([(shingles.sketch(x) >> np.uint64(40)).astype(np.uint8) for x in sets])


@pytest.mark.parametrize("sizes", [[2, 3, 5, 1, 40], [300, 2, 70, 700]])
def test_groups_and_links_against_all_pairs(sizes):
    pick = np.random.default_rng(5)
    units = []
    for n in sizes:
        rows = family(pick, n // 2, 60, 0.3) + family(pick, n - n // 2, 40, 0.15)
        units.append([rows[k] for k in pick.permutation(n)])
    marks = np.concatenate([matrix(x) for x in units])
    bounds, least = np.cumsum([0, *sizes]), chosenpath.passing(80)
    found = alike.groups(marks, bounds, least).tolist()
    for sets, first, last in zip(units, bounds.tolist(), bounds[1:].tolist()):
        own = marks[first:last]
        near = [(a, b) for a in range(len(sets)) for b in np.flatnonzero((own == own[a]).sum(axis=1) >= least).tolist()]
        assert found[first:last] == [first + x for x in least_labels(len(sets), near)]
        exact = [(a, b) for a, b in near if shingles.jaccard_at_least(sets[a], sets[b], 80)]
        forest = alike.links(own, [x.tobytes() for x in sets], least, 80)
        assert set(forest) <= set(exact)
        assert least_labels(len(sets), forest) == least_labels(len(sets), exact)
        assert len(forest) == len(sets) - len(set(least_labels(len(sets), exact)))


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_runs_hold_whole_keys(monkeypatch, rows):
    monkeypatch.setattr(chosenpath, "RUN_BYTES", 400)
    keys = np.repeat(np.arange(50), np.random.default_rng(1).integers(1, 30, 50))
    batches = pa.table({"unit": keys, "v": np.arange(len(keys))}).to_batches(max_chunksize=rows)
    seen, values = [], []
    for table, bounds in chosenpath.runs_by_key(iter(batches), "unit"):
        unit = table.column("unit").to_numpy()
        assert [len(set(unit[a:b])) for a, b in zip(bounds, bounds[1:])] == [1] * (len(bounds) - 1)
        seen += [unit[a] for a in bounds[:-1]]
        values += table.column("v").to_pylist()
    assert seen == list(range(50)) and values == list(range(len(keys)))


def test_a_large_group_of_near_copies_is_one_crowd(spark, monkeypatch):
    """Ten trees and many nodes find the same group; its sets must not be compared once for each of them."""
    ship(spark)
    monkeypatch.setattr(chosenpath, "NODE_ROWS", 16)
    monkeypatch.setattr(chosenpath, "BLOCK_ROWS", 40)
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join([*words[:k], f"x{k}", *words[k + 1 :]]) for k in range(120)]
    docs = spark.createDataFrame([*enumerate(texts), (900, "one of its own")], "doc_id long, text string")
    rows = docs.select("*", F.lit("").alias("body")).mapInArrow(chosenpath._signer(2), chosenpath.SIGNED)
    found = chosenpath.crowds(rows.select(F.col("doc_id").alias("rep"), "roots", "sketch"), 80).select("crowd", "rep").collect()
    assert sorted(x.rep for x in found) == list(range(120))
    assert len({x.crowd for x in found}) == 1
    assert {x.component_id for x in chosenpath.near_duplicates(docs, 2).collect()} == {0, 900}


def test_crowds_stay_apart_where_that_is_fewer_pairs(spark):
    chain = [(k, k, r) for k in range(40) for r in (k, k + 1)]
    star = [(100 + k, 1000, r) for k in range(3) for r in range(1000, 1010)]
    found = spark.createDataFrame([*chain, *star], "crowd long, head long, rep long")
    groups = {}
    for x in chosenpath._together(found).collect():
        groups.setdefault(x.crowd, []).append(x.rep)
    assert sorted(map(sorted, groups.values())) == [[k, k + 1] for k in range(40)] + [list(range(1000, 1010))]
