"""Bitmaps and containment against plain sets and strings."""

import random
import time

import pytest

from sheetlake.operators import bitmaps, containment, headers


def relation(spark):
    pick = random.Random(1)
    rows = [(f"s{k:05d}", i, f"n{pick.randint(0, 60)}") for k in range(700) for i in range(pick.randint(1, 9))]
    # One source with very many names, so that they fill more than one bucket.
    rows += [("wide", i, f"w{i}") for i in range(40_000)] + [("s00000", 99, "w39999"), ("s00001", 99, "w1")]
    return spark.createDataFrame(rows, "source string, pos int, name string"), rows


def test_counts_and_overlaps(spark):
    frame, rows = relation(spark)
    sources = bitmaps.numbered(frame, "source")
    assert sorted(x.no for x in sources.collect()) == list(range(701))
    found = bitmaps.presence_bitmaps(frame, sources)
    want = {tuple(x) for x in headers.presence_count(frame).collect()}
    assert {tuple(x) for x in bitmaps.bitmap_presence_count(found).collect()} == want

    names = {}
    for source, _, name in rows:
        names.setdefault(source, set()).add(name)
    for asked in (["n1"], ["n1", "n2"], ["n1", "n2", "n1"], ["n1", "absent"]):
        assert bitmaps.count_in_all(found, asked) == sum(set(asked) <= x for x in names.values())

    pairs = [("wide", "s00000"), ("wide", "s00001"), ("s00002", "s00003"), ("s00004", "wide"), ("s00002", "nowhere")]
    got = bitmaps.source_overlap(frame, spark.createDataFrame([*pairs, pairs[0]], "source_a string, source_b string"))
    assert {tuple(x) for x in got.collect()} == {(a, b, len(names[a] & names.get(b, set()))) for a, b in pairs}


def test_ten_thousand_keywords(spark):
    pick = random.Random(2)
    word = lambda n: "".join(pick.choices("abcdé二. ", k=n))
    said = [*(word(pick.randint(0, 40)) for _ in range(600)), None, "", "a", "ab"]
    said += said[:50]
    keywords = [*(word(pick.randint(1, 6)) for _ in range(10_000)), None, "", "a", said[0]]
    names = spark.createDataFrame([(x,) for x in said], "name string")
    frame = containment.containing_names(names, spark.createDataFrame([(x,) for x in keywords], "keyword string"))
    found = sorted(map(tuple, frame.collect()))
    want = sorted((k, n) for k in {x for x in keywords if x} for n in {x for x in said if x is not None} if k in n)
    assert found == want
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and plan.count("Join Inner, (") == 2


def test_nothing_to_find(spark):
    names, none = spark.createDataFrame([("abc",)], "name string"), spark.createDataFrame([], "keyword string")
    assert containment.containing_names(names, none).collect() == []
    assert containment.containing_names(names.limit(0), spark.createDataFrame([("a",)], "keyword string")).collect() == []


@pytest.mark.parametrize("small", [True, False])
def test_containment_either_way(spark, small):
    pick = random.Random(3)
    word = lambda n: "".join(pick.choices("abc\U0001f600\U0001f601é\n ", k=n))
    said = [*(word(pick.randint(0, 60)) for _ in range(200)), "abcabcab"]
    keywords = [*(word(pick.randint(1, 9)) for _ in range(1_500)), "bcabca", "abcabcabc", "\ufffd"]
    names = spark.createDataFrame([(x,) for x in said], "name string")
    frame = containment.containing_names(names, spark.createDataFrame([(x,) for x in keywords], "keyword string"), small)
    assert sorted(map(tuple, frame.collect())) == sorted((k, n) for k in set(keywords) for n in set(said) if k in n)


def test_long_names_take_time_in_proportion(spark):
    pick = random.Random(4)
    edge = 1 << 16
    text = "".join(pick.choices("abcdefgh ", k=600_000))
    text = text[: edge - 3] + "IJKLMNOP" + text[edge + 5 :]
    names = spark.createDataFrame([(text,)], "name string")
    keywords = spark.createDataFrame([(x,) for x in ("IJKLMNOP", "IJ", "NOP", text[-7:], "IJKLMNOPQ")], "keyword string")
    began = time.monotonic()
    found = containment.containing_names(names, keywords).select("keyword").collect()
    assert sorted(x.keyword for x in found) == sorted(["IJKLMNOP", "IJ", "NOP", text[-7:]])
    assert time.monotonic() - began < 60


def test_repeated_names_are_joined_once(spark, monkeypatch):
    rows = [("a", f"n{k % 7}") for k in range(7_000)] + [("b", "n1"), ("b", "n9"), ("b", None), (None, "n2")]
    sizes = {}

    def kept(frame, label, written=bitmaps.written):
        sizes[label] = (found := written(frame, label)).count()
        return found

    monkeypatch.setattr(bitmaps, "written", kept)
    frame, pairs = spark.createDataFrame(rows, "source string, name string"), spark.createDataFrame([("a", "b")], "source_a string, source_b string")
    assert [tuple(x) for x in bitmaps.source_overlap(frame, pairs).collect()] == [("a", "b", 1)]
    assert sizes["source-names"] == 9
