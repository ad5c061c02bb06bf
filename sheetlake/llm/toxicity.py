"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

At most ``SAMPLE`` labelled documents are the examples.  The vocabulary is all of
their terms.  Document frequencies come from all documents; a term weighs
more the more the labels of the sample depend on it (one plus the root of its chi-square statistic):
with plain weights the neighbours of a long text share its topic, not its label.
The index holds the examples' postings by term, and for every common term and block of examples
the largest weight.  A query adds up its strongest terms, and of the others reads only blocks that can
still reach its nearest ``NEIGHBOURS``, so the result is that of a full comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from sheetlake.llm.labelled import crc_mod, one_text_each, sample_labels, sample_texts
from sheetlake.llm.quality import _sigmoid, calibrate
from sheetlake.llm.ship import ship
from sheetlake.llm.spans import free_name
from sheetlake.llm.words import each_text
from sheetlake.session import written

SAMPLE = 4_000
NEIGHBOURS = 15
BLOCK = 128
#: Terms of so many examples have their postings in blocks.
COMMON = 16
SOFT = 0.05
FOLDS = 5
#: The share of a query's postings that is read before blocks are skipped.
OPEN = 0.75
#: The most terms that all examples together may have.
POSTINGS = 8_000_000

SCORED = (
    "doc_id long, held_out boolean, score double, predicted int, neighbours array<long>, similarities array<double>"
)

#: ASCII letters in lower case, bytes of other letters as they are, anything else a space.
_FOLD = bytes(ord(chr(b).lower()) if chr(b).isalpha() and b < 128 else b if b > 127 else 32 for b in range(256))


def term_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The terms of each text, as signed hashes."""
    for words in each_text([(x or "").encode("utf-8", "surrogatepass").translate(_FOLD) for x in texts]):
        yield words.view(np.int64)


def dependence(n_terms: int, examples: list[tuple[int, int, np.ndarray, np.ndarray]]) -> np.ndarray:
    """The chi-square statistic of each term and the label of the examples; 0 with one label only."""
    labels = np.array([x[1] for x in examples])
    ones, n = int((labels == 1).sum()), len(labels)
    zeros = n - ones
    a, b = np.zeros(n_terms), np.zeros(n_terms)
    for _, label, places, _ in examples:
        (a if label == 1 else b)[places] += 1
    spread = (a + b) * (n - a - b) * ones * zeros
    return np.divide((a * zeros - b * ones) ** 2 * n, spread, out=np.zeros(n_terms), where=spread > 0)


def _frequencies(known: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = known.value
        counts, n = np.zeros(len(terms) + 1, np.int64), 0
        for batch in batches:
            for words in term_hashes(batch.column(0).to_pylist()):
                places, _ = term_counts(words, terms)
                counts[places] += 1
            n += batch.num_rows
        counts[-1] = n
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(counts[filled])], ["place", "n"])

    return work


def term_counts(words: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted terms a text has, and how often."""
    if not len(terms) or not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.searchsorted(terms, words)
    place[place == len(terms)] = 0
    return np.unique(place[terms[place] == words], return_counts=True)


class Index:
    """Examples by term and by row, with the largest weight of each term and block of ``BLOCK`` rows."""

    def __init__(self, ids: list[int], labels: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int) -> None:
        # Rows with the same strongest terms are neighbours, so that the blocks' bounds are tight.
        order = sorted(range(len(ids)), key=lambda k: (tuple(vectors[k][0][np.argsort(-vectors[k][1])][:3].tolist()), ids[k]))
        self.ids = np.array([ids[k] for k in order], np.int64)
        self.labels = np.array([labels[k] for k in order], np.float64)
        self.n, self.n_blocks = len(order), -(-len(order) // BLOCK)
        sizes = np.array([len(vectors[k][0]) for k in order], np.int64)
        term = _joined([vectors[k][0] for k in order], np.int32)
        by_term = np.argsort(term, kind="stable")
        sorted_terms = term[by_term]
        self.row = np.repeat(np.arange(self.n), sizes)[by_term]
        self.row_weight = _joined([vectors[k][1] for k in order], np.float64)[by_term]
        self.term_start = np.searchsorted(sorted_terms, np.arange(terms + 1))
        self.most = np.zeros(terms)
        np.maximum.at(self.most, sorted_terms, self.row_weight)
        # Where the postings of each common term begin in each block, and the largest weight there.
        self.common = np.flatnonzero(np.diff(self.term_start) >= COMMON)
        self.place = np.full(terms, -1)
        self.place[self.common] = np.arange(len(self.common))
        edges = np.minimum(np.arange(self.n_blocks + 1) * BLOCK, self.n)
        self.block_start = np.empty((len(self.common), self.n_blocks + 1), np.int64)
        self.block_most = np.zeros((len(self.common), self.n_blocks))
        for k, t in enumerate(self.common.tolist()):
            first, last = self.term_start[t], self.term_start[t + 1]
            rows = self.row[first:last]
            self.block_start[k] = first + np.searchsorted(rows, edges)
            np.maximum.at(self.block_most[k], rows // BLOCK, self.row_weight[first:last])
        self.skipped = self.seen = 0

    def partial(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the given terms add to the cosine of every row."""
        at, sizes = ranges(self.term_start[terms], self.term_start[terms + 1])
        return np.bincount(self.row[at], self.row_weight[at] * np.repeat(weights, sizes), self.n)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and cosines of the k nearest examples with a cosine over 0; equal ones by row number.

        Rare terms and, by falling largest contribution, others are taken until ``OPEN`` of the postings are met.  The
        k-th best sum so far is to be beaten.  Of the other terms only the blocks are
        read in which a row could reach it with all that they could add there.
        """
        common = self.place[terms] >= 0
        order = np.argsort(np.where(common, -weights * self.most[terms], -np.inf), kind="stable")
        terms, weights = terms[order], weights[order]
        met = np.cumsum(self.term_start[terms + 1] - self.term_start[terms])
        cut = int(np.searchsorted(met, OPEN * met[-1])) + 1 if len(met) else 0
        cut = max(cut, len(terms) - int(common.sum()))
        found = self.partial(terms[:cut], weights[:cut])
        if cut < len(terms):
            least = float(np.partition(found, self.n - k)[self.n - k]) if k < self.n else 0.0
            rest, own = self.place[terms[cut:]], weights[cut:]
            reach = own @ self.block_most[rest] + np.maximum.reduceat(found, np.arange(0, self.n, BLOCK))
            live = np.flatnonzero(reach >= least - 1e-9)
            self.skipped, self.seen = self.skipped + self.n_blocks - len(live), self.seen + self.n_blocks
            if 2 * len(live) > self.n_blocks:
                found += self.partial(terms[cut:], own)
            else:
                at, sizes = ranges(self.block_start[rest[:, None], live].ravel(), self.block_start[rest[:, None], live + 1].ravel())
                found += np.bincount(self.row[at], self.row_weight[at] * np.repeat(np.repeat(own, len(live)), sizes), self.n)
                found[np.repeat(reach < least - 1e-9, BLOCK)[: self.n]] = 0.0
        return _first(found, k)


def ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of several ranges, and the ranges' sizes."""
    sizes = last - first
    skipped = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(first - skipped, sizes), sizes


def _joined(arrays: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *arrays]).astype(kind)


def _first(cosines: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest over 0, equal ones (to 12 digits) by place."""
    near = np.flatnonzero(cosines > 0)
    if len(near) > 4 * k:
        least = -np.partition(-cosines[near], k - 1)[k - 1]
        near = near[cosines[near] >= least - 1e-9]
    best = near[np.lexsort((near, -np.round(cosines[near], 12)))[:k]]
    return best, cosines[best]


class Scorer:
    """Term weights and the index of the examples, and the calibration of its votes."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray, examples: list[tuple[int, int, np.ndarray, np.ndarray]]) -> None:
        self.terms = terms
        self.weight = idf * (1 + np.sqrt(dependence(len(terms), examples)))
        vectors = [self.vector(places, counts) for _, _, places, counts in examples]
        labels = np.array([x[1] for x in examples], np.float64)
        filled = [k for k, x in enumerate(vectors) if len(x[0])]
        empty = np.array([labels[k] for k, x in enumerate(vectors) if not len(x[0])])
        self.base = float((empty.sum() + labels.mean()) / (len(empty) + 1)) if len(labels) else 0.0
        self.index = Index([examples[k][0] for k in filled], labels[filled], [vectors[k] for k in filled], len(terms))
        self.slope, self.shift = 1.0, 0.0

    def vector(self, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weights = (1 + np.log(counts)) * self.weight[places]
        keep = weights > 0
        weights = weights[keep]
        norm = np.sqrt((weights**2).sum())
        return places[keep], weights / norm if norm else weights

    def vote(self, words: np.ndarray) -> tuple[float, np.ndarray, np.ndarray] | None:
        """The neighbours' share of label 1, each by 1 / (distance + ``SOFT``); None without a known term or a neighbour."""
        vector = self.vector(*term_counts(words, self.terms)) if self.index.n else ((), ())
        if not len(vector[0]):
            return None
        rows, cosines = self.index.nearest(*vector, NEIGHBOURS)
        if not len(rows):
            return None
        weights = 1 / (1 - np.minimum(cosines, 1) + SOFT)
        return float((weights * self.index.labels[rows]).sum() / weights.sum()), rows, cosines

    def calibrate(self, votes: np.ndarray, labels: np.ndarray) -> None:
        """Learn how votes become probabilities, from texts that the votes' index doesn't hold."""
        if len(votes):
            self.slope, self.shift = calibrate(np.array([_logit(v) for v in votes]), labels)

    def score(self, words: np.ndarray) -> tuple[float, list[int], list[float]]:
        """Probability, and the neighbours it rests on; without a known term, the rate of such examples."""
        found = self.vote(words)
        if found is None:
            return self.base, [], []
        vote, rows, cosines = found
        p = float(_sigmoid(np.array(self.slope * _logit(vote) + self.shift)))
        return p, self.index.ids[rows].tolist(), cosines.tolist()


def _logit(vote: float) -> float:
    vote = min(max(vote, 0.01), 0.99)
    return float(np.log(vote / (1 - vote)))


def _example_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of each example and how often it has them, as bytes."""
    for batch in batches:
        found = [np.unique(x, return_counts=True) for x in term_hashes(batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.array([len(x[0]) for x in found], pa.int64()),
                pa.array([x[0].astype("<i8").tobytes() for x in found], pa.binary()),
                pa.array([x[1].astype("<i4").tobytes() for x in found], pa.binary()),
            ],
            ["doc_id", "label", "n", "terms", "counts"],
        )


def _votes(fitted: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The votes on examples that the index doesn't hold."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = fitted.value
        for batch in batches:
            texts = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            found = [scorer.vote(np.repeat(np.frombuffer(t, "<i8"), np.frombuffer(c, "<i4"))) for t, c in texts]
            votes = pa.array([None if x is None else x[0] for x in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(2), votes], ["label", "vote"])

    return work


def bounded_examples(docs: DataFrame, labels: DataFrame, rows: int, postings: int) -> DataFrame:
    """(doc_id, label, n, terms, counts) of at most ``rows`` labelled documents with at most ``postings`` terms in all.

    Documents are taken in the order of a hash of their ids; of several texts of one id, the one with the least hash counts.
    """
    picked = sample_labels(labels.withColumn("toxic", F.col("toxic").cast("int")), "toxic", rows)
    sample = one_text_each(sample_texts(docs, picked))
    found = written(
        sample.mapInArrow(_example_rows, "doc_id long, label int, n long, terms binary, counts binary"), "examples"
    )
    # One number per example, of which there are at most ``rows``.
    sizes = found.select(F.xxhash64("doc_id").alias("h"), "doc_id", "n").orderBy("h", "doc_id").collect()
    total = np.cumsum([x.n for x in sizes])
    over = [x.doc_id for x, upto in zip(sizes, total.tolist()) if upto > postings]
    return found.where(~F.col("doc_id").isin(over)) if over else found


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, postings: int = POSTINGS) -> Scorer:
    """Learn from a bounded sample of the labels; document frequencies of its terms from all of ``docs``.

    Calibration votes are those on every ``FOLDS``-th example by an index, and with weights, of the others.
    """
    context = docs.sparkSession.sparkContext
    sample = bounded_examples(docs, labels, rows, postings)
    found = sample.collect()
    said = [np.frombuffer(x.terms, "<i8") for x in found]
    terms = np.unique(np.concatenate([np.zeros(0, np.int64), *said]))
    known = context.broadcast(terms)
    counts = docs.select(F.col("text").cast("string")).mapInArrow(_frequencies(known), "place long, n long")
    summed = counts.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(terms) + 1)
    df[summed.column("place").to_numpy()] = summed.column("n").to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1]))
    examples = sorted(
        (
            (x.doc_id, x.label, np.searchsorted(terms, own), np.frombuffer(x.counts, "<i4").astype(np.int64))
            for x, own in zip(found, said)
        ),
        key=lambda x: x[0],
    )
    scorer = Scorer(terms, idf, examples)
    kept = {x.doc_id for x in sample.select("doc_id").where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)) != 0).collect()}
    partial = context.broadcast(Scorer(terms, idf, [x for x in examples if x[0] in kept]))
    others = sample.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)) == 0).select("terms", "counts", "label")
    votes = others.repartition(context.defaultParallelism).mapInArrow(_votes(partial), "label int, vote double")
    votes = votes.where("vote is not null").orderBy("vote", "label").toPandas()
    scorer.calibrate(votes["vote"].to_numpy(), votes["label"].to_numpy().astype(np.float64))
    return scorer


def _score(fitted: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = fitted.value
        for batch in batches:
            found = [scorer.score(x) for x in term_hashes(batch.column(2).to_pylist())]
            scores = [x[0] for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(scores, pa.float64()),
                    pa.array([int(x >= 0.5) for x in scores], pa.int32()),
                    pa.array([x[1] for x in found], pa.list_(pa.int64())),
                    pa.array([x[2] for x in found], pa.list_(pa.float64())),
                ],
                ["doc_id", "held_out", "score", "predicted", "neighbours", "similarities"],
            )

    return work


def held(doc_id: Column) -> Column:
    """Whether a document is kept out of all learning."""
    return F.coalesce(crc_mod(doc_id.cast("long"), 5) == 0, F.lit(True))


def learnable(labels: DataFrame) -> DataFrame:
    return labels.where(~held(F.col("doc_id")))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted and the evidence for every row of ``docs(doc_id, text)``.

    Labels are learned from documents that are not held out and have one distinct label.  A
    text that is null, or has no term of any example, scores the rate of such
    examples; without any usable label every score is 0.  Null ids are held out;
    repeated rows are scored one by one; other columns are ignored.
    """
    ship(docs.sparkSession)
    scorer = docs.sparkSession.sparkContext.broadcast(fit(docs, learnable(labels), rows))
    held_out = held(F.col("doc_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string"))
    return texts.mapInArrow(_score(scorer), SCORED)


def _not_toxic(fitted: Broadcast, place: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = fitted.value
        for batch in batches:
            keep = [scorer.score(x)[0] < 0.5 for x in term_hashes(batch.column(place).to_pylist())]
            # The last column is the text as it is scored.
            yield batch.filter(pa.array(keep, pa.bool_())).select(range(place))

    return work


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with all their columns.

    Every row is judged by its own text, whatever its ``doc_id`` is or repeats, and does not leave its place.
    """
    ship(docs.sparkSession)
    scorer = docs.sparkSession.sparkContext.broadcast(fit(docs, learnable(labels)))
    scored = free_name(docs.columns, "_scored")
    with_text = docs.select("*", F.col("text").cast("string").alias(scored))
    return with_text.mapInArrow(_not_toxic(scorer, len(docs.columns)), docs.schema)
