"""The prefix trie against a plain one, and centroid sums against sums by walking up."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sheetlake.llm import centroids, prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, node int"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows: list[tuple]) -> list[tuple]:
    said = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            said[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [x[2:] for x in sorted(v)] for c, v in said.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in said:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        whole = tuple(said.get(base, [])[:h] + said[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, own in members.items():
        up = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(own), len(node), up, len(own), kids[node], leaves[node], saved[node], sha))
    return sorted(out, key=str)


def run(spark, rows: list[tuple], **options: int) -> list[tuple]:
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    frame = prefixtrie.prefix_trie(docs, **options)
    assert frame.columns == NAMES
    return sorted(map(tuple, frame.collect()), key=str)


def talks(seed: int, n: int) -> list[tuple]:
    pick = random.Random(seed)
    words = ["hi", "hé 🙂", "", "no", "yes yes"]
    rows = []
    for c in range(n):
        for turn in range(pick.choice([1, 1, 2, 3, 9])):
            rows.append((c, turn, pick.choice(["user", "bot"]), pick.choice(words[: 2 + turn % 4]), "clash", 1))
    return rows


def odd() -> list[tuple]:
    rows = [(None, 1, "user", "lost", "", 0), (7, None, None, None, "", 0), (7, 0, "user", None, "", 0), (7, 0, "bot", "x", "", 0)]
    rows += [(7, 0, "bot", "x", "", 0), (-150, 3, "user", "a" * 50_000, "", 0), (-151, 3, "user", "a" * 50_000, "", 0)]
    # No conversation 900 to lend a beginning: some of these have no turns at all.
    rows += [(c, 1, "user", "only turn", "", 0) for c in range(901, 930)]
    return rows


def test_equals_a_plain_trie(spark):
    rows = talks(1, 260) + odd()
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("limit", [2, 40])
def test_large_trees_are_split_by_joins(spark, limit):
    rows = talks(2, 120) + odd()
    assert run(spark, rows, limit=limit) == brute(rows)


def test_a_long_conversation_and_many_equal_ones(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "SLICE", 16)
    rows = [(1, k, "user", f"turn {k // 2}", "", 0) for k in range(900)]
    rows += [(c, k, "user", f"turn {k}", "", 0) for c in range(200, 500) for k in range(3)]
    assert run(spark, rows) == brute(rows)


def test_an_empty_table_gives_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x", "", 0)]) == []


def forest(kind: str, n: int) -> np.ndarray:
    pick = np.random.default_rng(n)
    if kind == "chain":
        return np.arange(n) - 1
    if kind == "star":
        return np.where(np.arange(n) == 0, -1, 0)
    if kind == "caterpillar":
        return np.array([-1, *((k - 1) // 2 * 2 for k in range(1, n))])
    parent = np.array([pick.integers(-1, k) if k else -1 for k in range(n)], np.int64)
    return parent


def walked(parent: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = weights.copy()
    for k in range(len(parent) - 1, 0, -1):
        if parent[k] >= 0:
            out[parent[k]] += out[k]
    return out


@pytest.mark.parametrize("kind", ["chain", "star", "caterpillar", "random"])
@pytest.mark.parametrize("n", [0, 1, 2, 7, 600])
def test_centroid_sums_are_those_of_walking_up(kind, n):
    parent = forest(kind, n)[:n]
    depth, comp = np.zeros(n, np.int64), np.arange(n)
    for k in range(n):
        if parent[k] >= 0:
            depth[k], comp[k] = depth[parent[k]] + 1, comp[parent[k]]
    weights = np.random.default_rng(1).integers(0, 99, (n, 2))
    shuffled = np.random.default_rng(2).permutation(n)
    place = np.empty(n, np.int64)
    place[shuffled] = np.arange(n)
    own = np.where(parent[shuffled] < 0, -1, place[parent[shuffled]])
    pre, size = centroids.preorder(own, depth[shuffled])
    above = np.where(own < 0, -1, pre[own]) if n else own
    got = centroids.totals(comp[shuffled], pre, size, above, weights[shuffled])
    assert (got == walked(parent, weights)[shuffled]).all()
