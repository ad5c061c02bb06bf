"""Byte-level BPE by merge ranks: overlapping chunks, stitched where their pre-tokens agree.

A text is cut into chunks that overlap their successor.  Each chunk finds the
matches of the pre-token pattern from its own start.  Matching looks ahead
only, so from the first place where two neighbours both begin a match they
agree for good; the left chunk ends and the right one starts there.  The pieces
between such places are encoded in parallel and their ids joined in order.
A text whose chunks do not meet in some overlap (one match covers it) is
pre-tokenised from its start.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheetlake.llm.ship import ship
from sheetlake.session import written

CHUNK = 16_384
OVERLAP = 512
#: The longest look-ahead of the pattern beyond the end of a match, in characters, with room to spare.
AHEAD = 8

DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class RankCoder:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        size = max(ranks.values()) + 1
        self.raw: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            self.raw[rank] = token
        self.decimal = [b"%d" % k for k in range(size)]

    def encode(self, text: str) -> list[int]:
        return self.coder.encode_ordinary(text)

    def decode(self, ids: list[int]) -> bytes:
        """The concatenated bytes of the ids."""
        return b"".join(map(self.raw.__getitem__, ids))

    def starts(self, text: str, last: bool) -> list[int]:
        """Where matches begin behind visible text, as far as the end of the text can't have changed them."""
        safe = len(text) if last else len(text) - AHEAD
        out = []
        for match in self.pattern.finditer(text):
            if match.end() > safe:
                break
            if match.end() < len(text) and not text[match.end() - 1].isspace():
                out.append(match.end())
        return out


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> RankCoder:
    """One coder per worker process, rank file and pattern."""
    return RankCoder(path, pattern)


class _Digest:
    def __init__(self) -> None:
        self.n, self.ids, self.decoded = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, ids: list[int], use: RankCoder) -> None:
        if ids:
            self.ids.update((b"," if self.n else b"") + b",".join(map(use.decimal.__getitem__, ids)))
            self.decoded.update(use.decode(ids))
            self.n += len(ids)

    def values(self) -> tuple[int, str, str]:
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


def _digests(doc_ids: list[int | None], found: list[tuple[int, str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc_ids, pa.int64()),
            pa.array([x[0] for x in found], pa.int64()),
            pa.array([x[1] for x in found], pa.string()),
            pa.array([x[2] for x in found], pa.string()),
        ],
        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def _whole(path: str, pattern: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts of one chunk, and those that can't be cut."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(path, pattern)
        for batch in batches:
            found = []
            for text in batch.column(1):
                one = _Digest()
                one.add(use.encode(text.as_py() or ""), use)
                found.append(one.values())
            yield _digests(batch.column(0).to_pylist(), found)

    return work


def _cut(chunk: int, overlap: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_py()
                n = -(-len(text) // chunk)
                for first in range(0, n, 64):
                    numbers = range(first, min(n, first + 64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row] * len(numbers), pa.int64()),
                            pa.array([doc_id] * len(numbers), pa.int64()),
                            pa.array(list(numbers), pa.int64()),
                            pa.array([n] * len(numbers), pa.int64()),
                            pa.array([text[k * chunk : (k + 1) * chunk + overlap] for k in numbers], pa.string()),
                        ],
                        ["row", "doc_id", "no", "chunks", "text"],
                    )

    return work


def _mark(path: str, pattern: str, chunk: int, overlap: int) -> Callable:
    """For each chunk the places, counted from a chunk's start, where matches begin in its first and in its last overlap."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(path, pattern)
        for batch in batches:
            heads, tails = [], []
            columns = (batch.column(k).to_pylist() for k in (2, 3, 4))
            for no, chunks, text in zip(*columns):
                starts = use.starts(text, no == chunks - 1)
                heads.append([x for x in starts if x < overlap])
                tails.append([x - chunk for x in starts if x >= chunk])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, kind), pa.array(tails, kind)], [*batch.schema.names, "head", "tail"]
            )

    return work


def _joined(path: str, pattern: str) -> Callable:
    """Digests of texts whose pieces arrive in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(path, pattern)
        now, doc, one = None, None, _Digest()
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<u4")
            place = 0
            docs, found = [], []
            for row, doc_id, size in zip(*(x.to_pylist() for x in (batch.column(0), batch.column(1), batch.column(4)))):
                if now is not None and row != now:
                    docs.append(doc)
                    found.append(one.values())
                    one = _Digest()
                now, doc = row, doc_id
                one.add(ids[place : place + size].tolist(), use)
                place += size
            yield _digests(docs, found)
        if now is not None:
            yield _digests([doc], [one.values()])

    return work


def _encode_pieces(path: str, pattern: str) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(path, pattern)
        for batch in batches:
            ids = [use.encode(x) for x in batch.column(3).to_pylist()]
            packed = [np.array(x, "<u4").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(packed, pa.binary()), pa.array(list(map(len, ids)), pa.int64())],
                ["row", "doc_id", "no", "ids", "size"],
            )

    return work


def encoded_digests(
    docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs(doc_id, text)``.

    Texts of one chunk are encoded where they lie; the chunks of longer ones are
    spread over the cluster, and their ids are hashed and decoded in order as
    they stream by.  A null text is an empty one, without ids.  Rows with null
    or repeated ids count one by one.  Other columns are ignored.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    short = docs.where(F.length("text") <= chunk).mapInArrow(_whole(path, pattern), DIGEST)
    cut = (
        docs.where(F.length("text") > chunk)
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        .mapInArrow(_cut(chunk, overlap), "row long, doc_id long, no long, chunks long, text string")
    )
    cut = written(cut, "chunks")
    marked = written(
        cut.repartition("row", "no").mapInArrow(
            _mark(path, pattern, chunk, overlap),
            "row long, doc_id long, no long, chunks long, text string, head array<int>, tail array<int>",
        ),
        "marked",
    )
    ends = marked.select("row", (F.col("no") + 1).alias("no"), "tail")
    cuts = marked.where("no > 0").select("row", "no", "head").join(ends, ["row", "no"], "left")
    cuts = written(cuts.select("row", "no", F.array_min(F.array_intersect("head", "tail")).alias("cut")), "cuts")
    apart = cuts.where("cut is null").select("row").distinct()
    starts = cuts.select("row", "no", F.col("cut").alias("_first"))
    stops = cuts.select("row", (F.col("no") - 1).alias("no"), (F.col("cut") + chunk).alias("_last"))
    first = F.coalesce("_first", F.lit(0))
    text = F.substring("text", first + 1, F.coalesce("_last", F.length("text")) - first)
    pieces = (
        marked.select("row", "doc_id", "no", "text")
        .join(apart, "row", "left_anti")
        .join(starts, ["row", "no"], "left")
        .join(stops, ["row", "no"], "left")
        .select("row", "doc_id", "no", text.alias("text"))
        .mapInArrow(_encode_pieces(path, pattern), "row long, doc_id long, no long, ids binary, size long")
    )
    stitched = (
        pieces.repartition("row").sortWithinPartitions("row", "no").mapInArrow(_joined(path, pattern), DIGEST)
    )
    parts = cut.join(apart, "row", "left_semi").groupBy("row", "doc_id")
    uncut = parts.agg(
        F.array_sort(F.collect_list(F.struct("no", F.substring("text", 1, chunk).alias("text")))).alias("parts")
    ).select("doc_id", F.array_join(F.col("parts.text"), "").alias("text"))
    return short.unionByName(stitched).unionByName(uncut.mapInArrow(_whole(path, pattern), DIGEST))
