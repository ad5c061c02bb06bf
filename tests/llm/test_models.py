"""Language, toxicity and quality: rules against brute force, models by held-out accuracy."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sheetlake.llm import labelled, language, quality, toxicity
from sheetlake.llm.words import each_text

SMALL = "/root/testdata/sf0.01"


def brute_grams(text: str) -> list[int]:
    counts = Counter()
    letters = "".join(c if re.match(r"[^\W\d_]", c) else " " for c in text.lower())
    for word in letters.split():
        padded = f" {word} "
        for n in (1, 2, 3):
            counts.update(padded[k : k + n] for k in range(len(padded) - n + 1) if padded[k : k + n].strip())
    coded = {}
    for gram, n in counts.items():
        value = 0
        for c in gram:
            value = value << 21 | ord(c)
        coded[value] = coded.get(value, 0) + n
    return coded


def test_grams_and_profile():
    text = "Ça va, ça VA 12 a_b Straße\n中文"
    grams, counts = language.gram_counts(text)
    joined = dict(zip(grams.tolist(), counts.tolist()))
    want = brute_grams(text)
    lead = {k: v for k, v in joined.items()}
    assert set(lead) == set(want)
    ranked = language.profile(grams, counts, 10).tolist()
    assert ranked == sorted(joined, key=lambda x: (-joined[x], x))[:10]


def test_out_of_place_distance():
    profiles = language.Profiles({"x": [5, 7, 9], "y": [9, 5]})
    far = language.PROFILE
    assert profiles.distances(np.array([5, 9, 11])).tolist() == [0 + 1 + far, 1 + 1 + far]
    assert language.Profiles({}).predict("abc") == ("und", 0.0)


def test_language_of_nulls_blanks_and_ties(spark):
    rows = [(k, t, lang, "x") for k in range(60) for t, lang in (("the cat and the dog " * 3, "en"), ("der hund und die katze " * 3, "de"))]
    rows += [(500, None, "en", "x"), (501, "", "de", "x"), (502, "12 ½ --", None, "x"), (None, "the dog", None, "x"), (503, "und der hund", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(3)
    found = {}
    for x in language.languages(docs).collect():
        found.setdefault(x.doc_id, []).append(x)
        assert 0 <= x.score <= 1
        assert x.held_out == (x.doc_id is None or zlib.crc32(str(x.doc_id).encode()) % 3 == 1)
    assert [found[k][0].lang_pred for k in (500, 501, 502, None, 503)] == ["und", "und", "und", "en", "de"]
    assert sorted(x.lang_pred for x in found[7]) == ["de", "en"]
    assert language.languages(docs.limit(0)).count() == 0
    unknown = language.languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {x.lang_pred for x in unknown.collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'")
    assert found.where("lang = lang_pred").count() >= 0.95 * found.count()


def test_block_max_search_is_exact():
    pick = np.random.default_rng(4)
    for size in (0, 1, 63, 64, 300):
        vectors = []
        for _ in range(size):
            terms = np.sort(pick.choice(40, pick.integers(1, 8), replace=False))
            weights = pick.random(len(terms)).round(1) + 0.1
            vectors.append((terms, weights / np.sqrt((weights**2).sum())))
        index = toxicity.Index(list(range(size)), pick.integers(0, 2, size), vectors, 40)
        for _ in range(30):
            terms = np.sort(pick.choice(40, 5, replace=False))
            weights = np.full(5, 5**-0.5)
            query = np.zeros(40)
            query[terms] = weights
            exact = {k: float(sum(query[t] * w for t, w in zip(*v))) for k, v in enumerate(vectors)}
            best = sorted((round(x, 9) for x in exact.values() if x > 0), reverse=True)[:15]
            rows, cosines = index.nearest(terms, weights, 15)
            assert [round(x, 9) for x in cosines.tolist()] == best
            assert all(abs(exact[int(index.ids[r])] - c) < 1e-9 for r, c in zip(rows, cosines))


def toxic_rows() -> tuple[list[tuple], list[tuple]]:
    pick = random.Random(3)
    docs, labels = [], []
    for k in range(400):
        words = [pick.choice("abcdefghij") * pick.randint(1, 3) for _ in range(pick.randint(5, 60))]
        toxic = k % 5 == 0
        if toxic:
            words[1:1] = pick.sample(["Grumble,", "snarl", "HISS!"], 2)
        docs.append((k, " ".join(words), "x"))
        labels.append((k, int(toxic), 1))
    docs += [(900, None, "x"), (901, "", "x"), (902, "snarl hiss", "x"), (None, "grumble snarl hiss", "x"), (902, "snarl hiss", "x")]
    labels += [(901, None, 1), (5, 1, 1), (5, 0, 1), (None, 1, 1), (10_000, 1, 1)]
    return docs, labels


def test_toxicity(spark):
    docs, labels = toxic_rows()
    docs = spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(3)
    labels = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    found = {}
    for x in toxicity.toxicity(docs, labels).collect():
        found.setdefault(x.doc_id, []).append(x)
        assert 0 <= x.score <= 1 and x.predicted == (x.score >= 0.5)
        assert x.held_out == (x.doc_id is None or zlib.crc32(str(x.doc_id).encode()) % 5 == 0)
    assert [found[k][0].predicted for k in (900, 901, 902, None)] == [0, 0, 1, 1]
    assert len(found[902]) == 2 and found[902][0].neighbours
    held = [(x[0].predicted, int(k % 5 == 0)) for k, x in found.items() if k is not None and k < 400 and x[0].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and left.where("doc_id = 902").count() == 0
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    assert {x.predicted for x in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0}


def brute_counts(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) for j in range(3) if windows[tuple(words[k : k + 3])] > 1}
    seen, twice = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            twice += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), twice, len(covered)


def test_base_counts():
    pick = random.Random(5)
    texts = ["", " \n", "a b c a b c", "a\n\na\n a", *("".join(pick.choice("ab é#\n\t🙂*  ") for _ in range(pick.randint(0, 90))) for _ in range(400))]
    raw = [x.encode() for x in texts]
    for text, data, words in zip(texts, raw, each_text(raw)):
        assert quality.base_counts(data, words) == brute_counts(text)


def test_quality(spark):
    pick = random.Random(6)
    rows, labels = [], []
    for k in range(300):
        words = [pick.choice("bcdfg") + pick.choice("aeiou") * pick.randint(1, 2) + pick.choice("lmnrst") for _ in range(80)]
        good = k % 4 != 0
        rows.append((k, " ".join(words if good else [x + "%%" for x in words]), "x"))
        labels.append((k, int(good), 0))
    rows += [(900, None, "x"), (901, "few words", "x"), (902, "one two three " * 40, "x"), (None, rows[1][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(3)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {x.doc_id: x for x in quality.quality(docs, labels).collect()}
    assert len(found) == len(rows)
    for doc_id, text, _ in rows:
        x = found[doc_id]
        counts = brute_counts(text or "")
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == counts
        assert x.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (x.base_failed and x.kept)
    assert sum(found[k].kept == (k % 4 != 0) for k in range(300)) >= 290
    assert [found[k].kept for k in (900, 901, 902, None)] == [False, False, False, True]
    assert quality.quality(docs.limit(0), labels).count() == 0
    assert {x.probability for x in quality.quality(docs, labels.limit(0)).collect()} == {0.5}


def test_labels_must_agree(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (2, 1), (3, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    assert sorted(map(tuple, labelled.sample_labels(labels, "toxic", 10).collect())) == [(1, 1), (4, 0)]
    assert labelled.sample_labels(labels, "toxic", 1).count() == 1


def test_calibration_orders_and_bounds():
    logits = np.array([-3.0, -2, -1, 1, 2, 3] * 20)
    labels = (logits + np.tile([0, 0, 3, 0, -4, 0], 20) > 0).astype(float)
    slope, shift = quality.calibrate(logits, labels)
    assert slope > 0
    p = quality._sigmoid(slope * logits + shift)
    assert abs(p.mean() - labels.mean()) < 0.05


def test_examples_are_found_by_any_of_their_terms(spark):
    pick = random.Random(7)
    letters = str.maketrans("0123456789", "abcdefghij")
    docs = [(k, " ".join(f"rare{k}x{i}".translate(letters) for i in range(5)) + " " + pick.choice(["day", "night"])) for k in range(1, 200)]
    labels = [(k, int(k % 10 == 1), 1) for k, _ in docs]
    learned = [(k, x) for k, x in docs if zlib.crc32(str(k).encode()) % 5]
    copies = [(1000 + k, text) for k, text in learned]
    docs = spark.createDataFrame(docs + copies, "doc_id long, text string")
    found = {x.doc_id: x for x in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int")).collect()}
    for k, _ in learned:
        assert found[1000 + k].neighbours[0] == k
        assert abs(found[1000 + k].similarities[0] - 1) < 1e-9


def test_quality_sees_the_order_of_words(spark):
    """Texts of the same words, of which only the order differs."""
    pick = random.Random(8)
    rows, labels = [], []
    for k in range(400):
        words = []
        for _ in range(40):
            words += ["left", "right"] if k % 2 else ["right", "left"]
            words.append(pick.choice(["and", "or", "then", "but"]))
        rows.append((k, "".join(x + " " for x in words)))
        labels.append((k, k % 2))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(docs, labels)
    found = [(quality.THRESHOLD <= p, bool(k % 2)) for k, p in ((x.doc_id, x.probability) for x in quality.quality(docs, labels).collect())]
    assert sum(a == b for a, b in found) >= 390
    words = next(iter(quality.each_text([rows[1][1].encode()])))
    parts = [quality.SCALE * float(w[p].mean()) for w, p in (
        (model.words, quality.word_places(words)), (model.pairs, quality.pair_places(words)), (model.triples, quality.triple_places(rows[1][1])))]
    logit = model.slope * (model.bias + sum(parts)) + model.shift
    assert abs(model.probability(words, rows[1][1]) - 1 / (1 + np.exp(-logit))) < 1e-9
