"""Repeated passages by sliding spans of sentences.

A text is cut into sentences (at line ends and behind closing punctuation), and a
sentence of more than ``LONGEST`` words behind the word with the smallest hash of every
``LONGEST`` neighbouring words, so that each part counts as a sentence of its own.  Whether there is a cut
depends on less than ``LONGEST`` words on either side, so copies of a passage are cut
alike but for its ends, wherever they begin; a copy of 51 words has a span in common.  From every
sentence on, the shortest run of at least ``SENTENCES`` sentences and ``WORDS`` words
is a span.  Spans are joined globally by a 128-bit hash of their
normalised words; in all but the first place of a repeated span its sentences are
removed.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sheetlake.llm.scratch import Scratch
from sheetlake.llm.ship import ship
from sheetlake.session import written

SENTENCES = 3
WORDS = 20
LONGEST = 8

_SENTENCE = re.compile(r"[^\n.!?]*(?:[.!?](?!\s)[^\n.!?]*)*(?:[.!?]+\s*|\n\s*|\Z)")
_WORD = re.compile(r"\S+\s*")


def chosen(words: list[str]) -> list[int]:
    """The places of the smallest hash in each run of ``LONGEST`` words, of equal ones the last."""
    keys = [(zlib.crc32(x.encode("utf-8", "surrogatepass")) << 32) - k for k, x in enumerate(words)]
    least = {min(keys[k : k + LONGEST]) for k in range(len(keys) - LONGEST + 1)}
    return [k for k, x in enumerate(keys) if x in least]


def parts(text: str) -> Iterator[tuple[str, list[str]]]:
    """Consecutive parts of a text with their normalised words; together they are the text."""
    for match in _SENTENCE.finditer(text):
        part = match.group()
        words = part.lower().split()
        if len(words) <= LONGEST:
            if part:
                yield part, words
            continue
        ends = [x.end() for x in _WORD.finditer(part)]
        first, begin = 0, 0
        # Lower case may hold other white space than the text itself.
        alike = len(ends) == len(words)
        for k in chosen(words):
            if k < len(words) - 1:
                some = part[begin : ends[k]]
                yield some, words[first : k + 1] if alike else some.lower().split()
                first, begin = k + 1, ends[k]
        some = part[begin:]
        yield some, words[first:] if alike else some.lower().split()


def sentences(text: str) -> list[str]:
    """Consecutive parts of a text; together they are the text."""
    return [x for x, _ in parts(text)]


def spans(text: str) -> Iterator[tuple[int, int, bytes]]:
    """First part, number of parts and hash of each span.  Blank parts don't count, but are covered."""
    filled = [(k, len(x), " ".join(x)) for k, (_, x) in enumerate(parts(text)) if x]
    said = [x.encode("utf-8", "surrogatepass") for _, _, x in filled]
    last = 0
    total = 0
    for first in range(len(filled)):
        while last < len(filled) and (last - first < SENTENCES or total < WORDS):
            total += filled[last][1]
            last += 1
        if last - first < SENTENCES or total < WORDS:
            return
        digest = hashlib.blake2b(b" ".join(said[first:last]), digest_size=16).digest()
        yield filled[first][0], filled[last - 1][0] - filled[first][0] + 1, digest
        total -= filled[first][1]


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All spans of a batch of texts; ``later`` marks those that begin at an earlier place of the batch as well.

    Rows that repeat both id and text are one place, so of each batch only one of them is read.
    """
    for batch in batches:
        docs, bodies, firsts, sizes, hashes, known = [], [], [], [], [], set()
        for doc_id, body, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if (doc_id, body) in known:
                continue
            known.add((doc_id, body))
            for first, size, digest in spans(text.as_py() or ""):
                docs.append(doc_id)
                bodies.append(body)
                firsts.append(first)
                sizes.append(size)
                hashes.append(digest)
        if not docs:
            continue
        both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
        first, body = np.array(firsts, np.int32), np.array(bodies, np.int64)
        named = np.array([x is not None for x in docs])
        order = np.lexsort((first, body, np.array([x or 0 for x in docs], np.int64), named, both[:, 1], both[:, 0]))
        later = np.zeros(len(docs), bool)
        later[order[1:]] = (both[order[1:]] == both[order[:-1]]).all(axis=1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(docs, pa.int64()),
                pa.array(body),
                pa.array(first),
                pa.array(sizes, pa.int32()),
                pa.array(both[:, 0].copy()),
                pa.array(both[:, 1].copy()),
                pa.array(later),
            ],
            ["doc_id", "body", "first", "size", "high", "low", "later"],
        )


def _behind_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by hash and place, all but those at the first place of each hash.

    Rows of one place follow each other: row k is at the first place of its hash
    where it is the hash's first row, or at the same place as row k - 1 that is there.
    """
    last, leads = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        # An id that is null equals 0 here; such rows are never cut, and they are not at the place of others.
        named = pc.is_valid(batch.column(0)).to_numpy(zero_copy_only=False)
        doc_id = pc.fill_null(batch.column(0), 0).to_numpy()
        place = np.stack([named, doc_id, batch.column(1).to_numpy(), batch.column(2).to_numpy()])
        digest = np.stack([batch.column(4).to_numpy(), batch.column(5).to_numpy()])
        other_hash, other_place = np.ones(len(doc_id), bool), np.ones(len(doc_id), bool)
        other_hash[1:] = (digest[:, 1:] != digest[:, :-1]).any(axis=0)
        other_place[1:] = (place[:, 1:] != place[:, :-1]).any(axis=0)
        if last is not None:
            other_hash[0] = (digest[:, 0] != last[0]).any()
            other_place[0] = (place[:, 0] != last[1]).any()
        # Of each row, the last row at which hash or place changed; -1 lies in the batch before.
        run = np.maximum.accumulate(np.where(other_hash | other_place, np.arange(len(doc_id)), -1))
        first = np.where(run < 0, leads, other_hash[run])
        last, leads = (digest[:, -1], place[:, -1]), bool(first[-1])
        yield batch.filter(pa.array(~first)).select(["doc_id", "body", "first", "size"])


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, body, first, size): each span that began at an earlier place as well, by doc_id, body and sentence number.

    ``body`` is a hash of the text, so that rows which repeat an id are told apart by their texts.

    Every batch of texts settles its own repeats, so that of a hot passage one row per
    batch is left to be shuffled; these meet in order of place and all but the
    first are repeats too, with nothing held in memory.
    """
    ship(docs.sparkSession)
    with Scratch(docs.sparkSession) as scratch:
        kinds = "doc_id long, body long, first int, size int, high long, low long, later boolean"
        rows = scratch.written(docs.mapInArrow(_span_rows, kinds), "spans")
        met = (
            rows.where("not later")
            .repartition("high", "low")
            .sortWithinPartitions("high", "low", "doc_id", "body", "first")
            .mapInArrow(_behind_first, "doc_id long, body long, first int, size int")
        )
        settled = rows.where("later").select("doc_id", "body", "first", "size")
        return written(settled.unionByName(met).where("doc_id is not null"), "repeats")


def remove(text: str, covered: list[dict]) -> tuple[str, int, int]:
    """The text without covered sentences, their number, and the number of all sentences."""
    known = sentences(text)
    gone = {k for x in covered for k in range(x["first"], x["first"] + x["size"])}
    return "".join(x for k, x in enumerate(known) if k not in gone), len(gone), len(known)


def _cleaned(columns: list[str], count: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The last column holds what is covered; it becomes the count of sentences cut."""
    place = columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = [], []
            for text, covered in zip(batch.column(place), batch.column(len(columns))):
                text, covered = text.as_py(), covered.as_py()
                n = 0
                if covered:
                    text, n, _ = remove(text or "", covered)
                texts.append(text)
                gone.append(n)
            arrays = batch.columns[: len(columns)]
            arrays[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(gone, pa.int64())], [*columns, count])

    return work


def free_name(columns: list[str], name: str) -> str:
    """The name, with underscores in front until no column has it."""
    taken = {x.lower() for x in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without_repeats(docs: DataFrame, count: str = "n_removed") -> DataFrame:
    """All rows and columns of ``docs``, with repeated passages cut out of ``text``, and ``count``: sentences cut.

    The first place of a span is that of the smallest ``doc_id``, then of the
    earlier sentence.  A null or empty text stays as it is.  A row without
    ``doc_id`` comes before all others and is never cut.  Rows that repeat both ``doc_id`` and text are one
    document, of which the first place stays in every row; rows that repeat only the ``doc_id`` are
    documents of their own, in order of a hash of their texts.  A column that is named like ``count`` is
    replaced; all others stay.  An empty table gives no rows.
    """
    docs = docs.drop(count).withColumn("text", F.col("text").cast("string"))
    found = repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("body"), "text"))
    key, listed = free_name(docs.columns, "_key"), free_name(docs.columns, "_covered")
    own = free_name(docs.columns, "_own")
    covered = found.groupBy(F.col("doc_id").alias(key), F.col("body").alias(own)).agg(
        F.collect_set(F.struct("first", "size")).alias(listed)
    )
    same = (docs["doc_id"] == covered[key]) & (F.xxhash64(docs["text"]) == covered[own])
    joined = docs.join(covered, same, "left").drop(key, own)
    kinds = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in docs.schema)
    return joined.mapInArrow(_cleaned(docs.columns, count), f"{kinds}, `{count}` long")
