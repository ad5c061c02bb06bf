"""Quality rules: counts of words, symbols and repeats, then a calibrated logistic regression on hashed n-grams.

The regression is fitted on at most ``SAMPLE`` labelled rows.  Its features are
the shares of hashed words, hashed runs of two words and hashed character triples of a text; its logits
are turned into probabilities by a two-parameter fit on rows held back from
training.  Whole texts are scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheetlake.llm.labelled import one_text_each, sample_labels, sample_texts
from sheetlake.llm.ship import ship
from sheetlake.llm.words import SPACES, each_text, mix

SAMPLE = 4_000
BITS = 14
KINDS = 3
SCALE = 20.0
STEPS = 150
RATE = 0.3
THRESHOLD = 0.5
FEWEST_WORDS = 50
MOST_REPEATED = 50

SCORED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "probability double"
)

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass
class Model:
    """Weights per hashed word, run of two words and character triple, bias, and the two parameters of the calibration."""

    words: np.ndarray
    pairs: np.ndarray
    triples: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, words: np.ndarray, text: str) -> float:
        logit = self.bias
        kinds = (self.words, word_places(words)), (self.pairs, pair_places(words)), (self.triples, triple_places(text))
        for weights, places in kinds:
            if len(places):
                logit += SCALE * float(weights[places].mean())
        return float(_sigmoid(np.array(self.slope * logit + self.shift)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def word_places(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BITS)).astype(np.int64)


def pair_places(words: np.ndarray) -> np.ndarray:
    """Hashed runs of two words, so that their order counts."""
    return word_places(mix(words[:-1] + np.uint64(1)) ^ mix(words[1:] + np.uint64(2)) * np.uint64(3))


def triple_places(text: str) -> np.ndarray:
    """Hashed runs of three characters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) < 3:
        return np.zeros(0, np.int64)
    together = points[:-2] * np.uint32(0x9E3779B1)
    together = (together ^ points[1:-1]) * np.uint32(0x85EBCA77)
    together = (together ^ points[2:]) * np.uint32(0xC2B2AE3D)
    together ^= together >> np.uint32(15)
    together *= np.uint32(0x27D4EB2F)
    return (together >> np.uint32(32 - BITS)).astype(np.int64)


def repeated_words(words: np.ndarray) -> int:
    """Words that lie in a window of three words which the text has twice or more."""
    if len(words) < 4:
        return 0
    windows = mix(mix(words[:-2] + np.uint64(1)) ^ mix(words[1:-1] + np.uint64(2)) * np.uint64(3) ^ mix(words[2:]))
    order = np.argsort(windows, kind="stable")
    sorted_ = windows[order]
    same = sorted_[1:] == sorted_[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(windows)] |= twice
    return int(covered.sum())


def repeated_lines(raw: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def base_counts(raw: bytes, words: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    values = np.frombuffer(raw, np.uint8)
    chars = int(((values & 0xC0) != 0x80).sum()) - int(SPACES[values].sum())
    return len(words), chars, int(_SYMBOLS[values].sum()), repeated_lines(raw), repeated_words(words)


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str, bytes, np.ndarray]]:
    texts = [x or "" for x in batch.column(1).to_pylist()]
    raw = [x.encode("utf-8", "surrogatepass") for x in texts]
    yield from zip(batch.column(0).to_pylist(), texts, raw, each_text(raw))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse shares of each labelled text: 2**BITS places for words, as many for runs of two, then triples."""
    for batch in batches:
        places, shares = [], []
        for _, text, _, words in _rows_of(batch):
            place, share = [], []
            for kind, some in enumerate((word_places(words), pair_places(words), triple_places(text))):
                counts = np.bincount(some, minlength=1)
                filled = np.flatnonzero(counts)
                place.append(filled + (kind << BITS))
                share.append(counts[filled] * (SCALE / max(1, len(some))))
            places.append(np.concatenate(place).astype(np.int32))
            shares.append(np.concatenate(share).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(batch.column(2).to_pylist(), pa.int32()),
                pa.array(places, pa.list_(pa.int32())),
                pa.array(shares, pa.list_(pa.float32())),
            ],
            ["doc_id", "label", "places", "shares"],
        )


def fit(labels: np.ndarray, places: list[np.ndarray], shares: list[np.ndarray]) -> Model:
    """Logistic regression by Adam steps on three quarters of the rows, calibrated on the rest."""
    size = KINDS << BITS
    if len(labels) < 8 or labels.min() == labels.max():
        rate = (labels.sum() + 1) / (len(labels) + 2)
        return Model(*np.zeros((KINDS, 1 << BITS)), float(np.log(rate / (1 - rate))), 1.0, 0.0)
    learn = np.arange(len(labels)) % 4 != 3
    if labels[learn].min() == labels[learn].max():
        learn[:] = True
    index, value = np.concatenate(places), np.concatenate(shares).astype(np.float64)
    row = np.repeat(np.arange(len(labels)), [len(x) for x in places])
    n = len(labels)
    weights, bias = np.zeros(size), 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        logits = np.bincount(row, value * weights[index], n) + bias
        error = np.where(learn, _sigmoid(logits) - labels, 0.0) / learn.sum()
        slope = np.append(np.bincount(index, value * error[row], size) + 1e-6 * weights, error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = RATE * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    logits = np.bincount(row, value * weights[index], n) + bias
    held = ~learn
    if not held.any() or labels[held].min() == labels[held].max():
        held[:] = True
    a, b = calibrate(logits[held], labels[held])
    return Model(*weights.reshape(KINDS, -1), float(bias), a, b)


def calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the logits of held-back rows probabilities, by Newton steps with softened targets."""
    ones = labels.sum()
    zeros = len(labels) - ones
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    scale = max(1.0, float(np.abs(logits).max()))
    x = np.stack([logits / scale, np.ones(len(logits))], axis=1)
    theta = np.zeros(2)
    for _ in range(50):
        p = _sigmoid(x @ theta)
        slope = x.T @ (p - target) + 1e-3 * theta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, slope)
        theta -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-9:
            break
    return float(max(theta[0], 0.0) / scale), float(theta[1])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [x for batch in batches for x in batch.to_pylist()]
    # In an order that has nothing to do with the ids, as every fourth row is held back.
    rows.sort(key=lambda x: (zlib.crc32(str(x["doc_id"]).encode()), x["doc_id"], x["label"]))
    labels = np.array([x["label"] for x in rows], np.float64)
    model = fit(labels, [np.array(x["places"], np.int64) for x in rows], [np.array(x["shares"]) for x in rows])
    yield pa.RecordBatch.from_pylist(
        [
            {
                "words": model.words.astype("<f4").tobytes(),
                "pairs": model.pairs.astype("<f4").tobytes(),
                "triples": model.triples.astype("<f4").tobytes(),
                "numbers": [model.bias, model.slope, model.shift],
            }
        ]
    )


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", rows: int = SAMPLE) -> Model:
    """Fit on a sample of at most ``rows`` labelled documents, in one task; the model has a fixed size."""
    sample = one_text_each(sample_texts(docs, sample_labels(labels.withColumn(column, F.col(column).cast("int")), column, rows)))
    features = sample.select("doc_id", "text", "label").mapInArrow(
        _features, "doc_id long, label int, places array<int>, shares array<float>"
    )
    found = features.repartition(1).mapInArrow(_train, "words binary, pairs binary, triples binary, numbers array<double>").collect()
    if not found:
        return fit(np.zeros(0), [], [])
    return Model(*(np.frombuffer(found[0][k], "<f4") for k in range(KINDS)), *found[0].numbers)


def _scorer(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (doc_id, *base_counts(raw, words), model.probability(words, text))
                for doc_id, text, raw, words in _rows_of(batch)
            ]
            names = [x.split()[0] for x in SCORED.split(", ")]
            kinds = [pa.int64()] * 6 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names)

    return score


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = SAMPLE) -> DataFrame:
    """Counts, base_failed, probability and kept for every row of ``docs(doc_id, text)``.

    A row fails the base rules with fewer than ``FEWEST_WORDS`` words or when more than
    ``MOST_REPEATED`` percent of its words lie in repeated three-word windows; any
    other is kept from ``threshold`` on.  A null text has no words.  Null ids and
    repeated rows are scored one by one; other columns are ignored.  Without usable labels every
    probability is one half, so only the base rules decide.
    """
    ship(docs.sparkSession)
    model = train(docs, labels, rows=rows)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    failed = (F.col("n_words") < FEWEST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    return (
        texts.mapInArrow(_scorer(model), SCORED)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= threshold))
    )
