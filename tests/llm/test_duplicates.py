"""Exact copies, near copies, components and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetlake.llm import chosenpath, links, recipes, shingles, spans, words

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def corpus(seed: int = 1) -> list[tuple]:
    """Documents with exact copies, copies in other case, near copies at many distances, nulls and blanks."""
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choice("abcdeé") for _ in range(pick.randint(1, 6))) for _ in range(300)]
    rows = []
    for _ in range(60):
        base = [pick.choice(vocabulary) for _ in range(pick.randint(1, 80))]
        for _ in range(pick.randint(1, 6)):
            own = [pick.choice(vocabulary) if pick.random() < pick.choice([0, 0.02, 0.1]) else x for x in base]
            text = pick.choice([" ", "  ", "\n"]).join(own)
            rows.append(text.upper() if pick.random() < 0.2 else text)
    rows += [None, "", " \n", "one", "ONE", "one two", "É", "é", "x" * 5000, "x. " * 3000, "x. " * 3000]
    pick.shuffle(rows)
    return [(k, x, "clash") for k, x in enumerate(rows)]


@pytest.mark.parametrize("identify", [F.xxhash64, lambda x: (F.length(x) % 3).cast("long")])
def test_exact_groups(spark, identify):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id string").repartition(3)
    found = {x.doc_id: x for x in recipes.exact_groups(docs, identify).collect()}
    groups = {}
    for doc_id, text, _ in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    for text, ids in groups.items():
        for doc_id in ids:
            x = found[doc_id]
            digest = hashlib.sha256(text.encode()).hexdigest()
            assert (x.keep_id, x.group_size, x.kept, x.text_sha256) == (max(ids), len(ids), doc_id == max(ids), digest)
    kept = recipes.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted(max(x) for x in groups.values())


def test_exact_groups_of_null_ids_and_repeated_rows(spark):
    rows = [(None, "a"), (None, "A"), (1, "b"), (None, "b"), (2, "c"), (2, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(x.doc_id), str(x.keep_id), x.group_size, x.kept) for x in recipes.exact_groups(docs).collect())
    assert found == sorted(
        [("None", "None", 2, True)] * 2 + [("1", "1", 2, True), ("None", "1", 2, False)] + [("2", "2", 2, True)] * 2
    )
    assert recipes.exact_groups(docs.limit(0)).count() == 0


def test_chunks_are_the_text(spark):
    pick = random.Random(2)
    texts = ["", "a", "x" * 30_000, "".join(pick.choice("ab .\n🙂") for _ in range(20_000))]
    docs = spark.createDataFrame([(x,) for x in texts], "text string")
    for row in docs.select("text", recipes.chunks(F.col("text")).alias("parts")).collect():
        assert "".join(row.parts) == row.text
        assert all(len(x) <= recipes.LONGEST for x in row.parts)


def brute_near(rows: list[tuple], size: int, percent: int) -> dict[int, tuple]:
    sets = {}
    for doc_id, text, *_ in rows:
        said = (text or "").encode().lower().split()
        n = min(size, len(said))
        sets[doc_id] = {tuple(said[k : k + n]) for k in range(len(said) - n + 1)} if said else set()
    up = {x: x for x in sets}

    def find(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {x: (len(sets[x]), find(x), find(x) == x) for x in sets}


@pytest.mark.parametrize(("size", "rows_in_node"), [(2, 4096), (2, 8), (5, 4096)])
def test_near_duplicates(spark, monkeypatch, size, rows_in_node):
    monkeypatch.setattr(chosenpath, "NODE_ROWS", rows_in_node)
    monkeypatch.setattr(chosenpath, "UNIT_BYTES", 4096 if rows_in_node == 8 else 32 << 20)
    rows = corpus(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string, rep string").repartition(3)
    found = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in chosenpath.near_duplicates(docs, size).collect()}
    want = brute_near(rows, size, 80)
    assert found == want
    left = chosenpath.drop_near_copies(docs, size)
    assert left.columns == docs.columns
    assert sorted(x.doc_id for x in left.collect()) == sorted(k for k, x in want.items() if x[2])


def test_near_duplicates_of_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (9, "A B C")], "doc_id long, text string")
    found = sorted((str(x.doc_id), str(x.component_id), x.kept) for x in chosenpath.near_duplicates(docs, 2).collect())
    assert found == [("4", "4", True), ("4", "4", True), ("9", "4", False), ("None", "None", True)]
    assert chosenpath.near_duplicates(docs.limit(0)).count() == 0


def test_threshold_is_exact():
    a = np.arange(10, dtype=np.uint64)
    assert shingles.jaccard_at_least(a, a[:8], 80)
    assert not shingles.jaccard_at_least(a, a[:7], 80)
    assert not shingles.jaccard_at_least(a[:0], a[:0], 80)


def test_components(spark):
    pick = random.Random(6)
    edges = [(k, k + 1) for k in range(100, 160)] + [(0, k) for k in range(1, 40)] + [(200, 200), (None, 3)]
    edges += [(pick.randint(300, 500), pick.randint(300, 500)) for _ in range(120)]
    found = {x.id: x.component for x in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}
    for a, b in edges:
        if a is not None and a != b:
            for x in (a, b):
                up.setdefault(x, {x})
            whole = up[a] | up[b]
            for x in whole:
                up[x] = whole
    assert found == {x: min(y) for x, y in up.items()}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes(monkeypatch):
    pick = random.Random(8)
    texts = ["".join(pick.choice("ab é\n\t🙂 ") for _ in range(pick.randint(0, 60))).encode() for _ in range(300)]
    known = {}
    for block in (1 << 20, 20):
        monkeypatch.setattr(words, "BLOCK_BYTES", block)
        for text, hashes in zip(texts, words.each_text(texts)):
            said = text.split()
            assert len(said) == len(hashes)
            for word, value in zip(said, hashes.tolist()):
                assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


PASSAGE = "First of all this was said here before. Then came a second sentence of some words. And a third one ends it all now."


def test_repeated_passages_are_cut_behind_the_first(spark):
    rows = [
        (5, f"Own start of five. {PASSAGE} Own end of five.", 1),
        (2, f"Own start of two.\n{PASSAGE.upper()}\nOwn end of two.", 1),
        (7, f"{PASSAGE} {PASSAGE}", 1),
        (8, "One. Two. Three. One. Two. Three.", 1),
        (9, None, 1),
        (10, "", 1),
        (None, f"No id. {PASSAGE}", 1),
        (11, " ".join(["w%d" % k for k in range(70)]), 1),
        (12, " ".join(["w%d" % k for k in range(70)]) + " x", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _covered int").repartition(3)
    found = {x.doc_id: (x.text, x.n_removed) for x in spans.without_repeats(docs).collect()}
    assert found[None] == (rows[6][1], 0)
    assert found[2] == ("Own start of two.\nOwn end of two.", 3)
    assert found[5] == ("Own start of five. Own end of five.", 3)
    assert found[7][0] == ""
    assert found[8] == (rows[3][1], 0)
    assert found[9] == (None, 0) and found[10] == ("", 0)
    assert found[11] == (rows[7][1], 0)
    assert len(found[12][0].split()) < 20
    assert spans.without_repeats(docs.limit(0)).count() == 0


def test_spans_against_brute_force(spark):
    pick = random.Random(9)
    pool = [" ".join(pick.choice("abcdefgh") * pick.randint(1, 3) for _ in range(pick.randint(1, 12))) + "." for _ in range(40)]
    rows = [(k, " ".join(pick.choice(pool) for _ in range(pick.randint(1, 30)))) for k in range(60)]
    seen, want = set(), {}
    for doc_id, text in rows:
        parts = spans.sentences(text)
        assert "".join(parts) == text
        gone = set()
        for first in range(len(parts)):
            last = first
            while last < len(parts) and (last - first < spans.SENTENCES or len("".join(parts[first:last]).split()) < spans.WORDS):
                last += 1
            run = parts[first:last]
            said = " ".join("".join(run).split())
            if len(run) < spans.SENTENCES or len(said.split()) < spans.WORDS:
                break
            gone |= set(range(first, last)) if said in seen else set()
            seen.add(said)
        want[doc_id] = "".join(x for k, x in enumerate(parts) if k not in gone)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id: x.text for x in spans.without_repeats(docs).collect()} == want


def test_passages_without_sentence_ends_are_found_at_every_offset(spark):
    passage = [f"said{k}" for k in range(51)]
    for gap in (None, 14, 24):
        marked = [x + "." if gap and k in (gap, gap + 10, gap + 20) else x for k, x in enumerate(passage)]
        rows = [(0, " ".join(["first", *marked, "last"]))]
        for k in range(1, 42):
            own = [f"own{k}x{i}" for i in range(60)]
            rows.append((k, " ".join([*own[:k], *marked, *own[k:]])))
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        found = {x.doc_id: (x.text or "").split() for x in spans.without_repeats(docs).collect()}
        assert found[0] == rows[0][1].split()
        for k, text in rows[1:]:
            left = found[k]
            assert [x for x in left if x.startswith("own")] == [x for x in text.split() if x.startswith("own")]
            assert sum(x.startswith("said") for x in left) <= 51 - spans.WORDS


def test_parts_have_at_most_longest_words():
    pick = random.Random(12)
    for n in (1, 8, 9, 100, 1000):
        for words in ([pick.choice("abcdefgh") * pick.randint(1, 4) for _ in range(n)], ["same"] * n):
            text = "  " + " \t".join(words)
            parts = spans.sentences(text)
            assert "".join(parts) == text
            assert max(len(x.split()) for x in parts) <= spans.LONGEST


def test_equal_rows_keep_the_first_place(spark):
    own = "Nothing of this is said by any other row at all. It has words. And it ends here with some more words now."
    rows = [(2, f"Of two. {PASSAGE}"), (2, f"Of two. {PASSAGE}"), (3, PASSAGE), (4, f"{PASSAGE} {PASSAGE}")] * 2
    rows += [(3, own), (None, "No id at all. " * 9), (None, "No id at all. " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 11):
        found = [(x.doc_id, x.text) for x in spans.without_repeats(docs.repartition(parts)).collect()]
        want = [(2, rows[0][1])] * 4 + [(3, "")] * 2 + [(4, "")] * 2 + [(3, own)] + rows[-2:]
        assert sorted(found, key=str) == sorted(want, key=str)


def test_one_of_wholly_repeated_rows_stays(spark):
    rows = [(2, "a b", "x"), (2, "a b", "x"), (1, "a b", "x"), (4, "c", "x"), (None, "d", "x"), (None, "d", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _sha string").repartition(3)
    left = recipes.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(map(str, (tuple(x) for x in left.collect()))) == sorted(map(str, [rows[0], rows[3], rows[4]]))
