"""Token shards as wavelet matrices: one compressed file per shard, with access, rank and select.

A shard holds the ids of neighbouring documents in ascending ``doc_id`` order.
Its file is Parquet with one row: the bit-planes of the wavelet matrix (most
significant first, eight bits a byte), for every plane the count of ones before
each block of 512 bits, and the directory of its documents.  Queries on a
shard (token at a place, count of an id before a place, place of its n-th
occurrence) touch the planes only; no plain copy of the ids is stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sheetlake.llm.encode import encoder
from sheetlake.llm.ship import ship
from sheetlake.session import scratch_path

SHARD_TOKENS = 4_000_000
BLOCK_BITS = 512
#: Ids that are parted by a bit at a time: what is touched stays in the processor's cache.  Whole bytes of a plane.
PARTED_IDS = 1 << 16
#: Pieces that a worker remembers while it writes shards; rare words come again within a few batches.
CACHE_PIECES = 1_000_000

SHARD_SCHEMA = (
    "part int, seq int, n_tokens long, width int, planes array<binary>, ranks array<binary>, "
    "doc_ids array<long>, lengths array<long>"
)


@dataclass
class WaveletMatrix:
    """A sequence of ids below 2**width as permuted bit-planes."""

    size: int
    width: int
    planes: list[np.ndarray]
    ranks: list[np.ndarray]

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        planes, ranks = [], []
        now, after, upper = ids.copy(), np.empty_like(ids), np.empty_like(ids)
        for level in range(width):
            bit = ids.dtype.type(1 << (width - 1 - level))
            packed = np.empty(-(-len(ids) // 8), np.uint8)
            low = high = 0
            for first in range(0, len(ids), PARTED_IDS):
                part = now[first : first + PARTED_IDS]
                ones = (part & bit) != 0
                packed[first // 8 : (first + len(part) + 7) // 8] = np.packbits(ones)
                # Places, not masks: taking by a mask mispredicts a branch at every other id.
                zeros, ones = np.flatnonzero(~ones), np.flatnonzero(ones)
                np.take(part, zeros, out=after[low : low + len(zeros)], mode="clip")
                np.take(part, ones, out=upper[high : high + len(ones)], mode="clip")
                low, high = low + len(zeros), high + len(ones)
            after[low:] = upper[:high]
            now, after = after, now
            blocks = np.bitwise_count(np.pad(packed, (0, -len(packed) % (BLOCK_BITS // 8)))).reshape(-1, BLOCK_BITS // 8)
            before = np.zeros(len(blocks) + 1, "<u8")
            np.cumsum(blocks.sum(axis=1, dtype="u8"), out=before[1:])
            planes.append(packed)
            ranks.append(before)
        return cls(len(ids), width, planes, ranks)

    def zeros(self, level: int) -> int:
        return self.size - int(self.ranks[level][-1])

    def rank1(self, level: int, place: int) -> int:
        """Ones of a plane before a place."""
        block = place // BLOCK_BITS
        first = block * BLOCK_BITS // 8
        whole, rest = divmod(place, 8)
        count = int(self.ranks[level][block]) + int(np.bitwise_count(self.planes[level][first:whole]).sum())
        return count + ((int(self.planes[level][whole]) >> (8 - rest)).bit_count() if rest else 0)

    def bit(self, level: int, place: int) -> int:
        return int(self.planes[level][place // 8]) >> (7 - place % 8) & 1

    def access(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.size:
            raise IndexError(place)
        value = 0
        for level in range(self.width):
            bit, ones = self.bit(level, place), self.rank1(level, place)
            value = value << 1 | bit
            place = self.zeros(level) + ones if bit else place - ones
        return value

    def _down(self, value: int, place: int) -> int:
        for level in range(self.width):
            ones = self.rank1(level, place)
            place = self.zeros(level) + ones if value >> (self.width - 1 - level) & 1 else place - ones
        return place

    def rank(self, value: int, place: int) -> int:
        """How often an id occurs before a place."""
        if value >> self.width:
            return 0
        return self._down(value, place) - self._down(value, 0)

    def select(self, value: int, n: int) -> int:
        """The place of the n-th occurrence of an id, counted from 0; -1 if there are fewer."""
        if n < 0 or n >= self.rank(value, self.size):
            return -1
        place = self._down(value, 0) + n
        for level in reversed(range(self.width)):
            if value >> (self.width - 1 - level) & 1:
                place = self._select_bit(level, 1, place - self.zeros(level))
            else:
                place = self._select_bit(level, 0, place)
        return place

    def _select_bit(self, level: int, bit: int, n: int) -> int:
        ones = self.ranks[level].astype("i8")
        before = ones if bit else np.arange(len(ones), dtype="i8") * BLOCK_BITS - ones
        block = int(np.searchsorted(before, n, side="right")) - 1
        first = block * BLOCK_BITS // 8
        bits = np.unpackbits(self.planes[level][first : first + BLOCK_BITS // 8])
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[n - int(before[block])])

    def all_ids(self) -> np.ndarray:
        """Every id, from the last plane up: each level undoes one stable partition."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        now, above = np.zeros(self.size, kind), np.empty(self.size, kind)
        for level in reversed(range(self.width)):
            low, high = 0, self.zeros(level)
            now[high:] |= kind(1 << (self.width - 1 - level))
            for first in range(0, self.size, PARTED_IDS):
                part = above[first : first + PARTED_IDS]
                ones = np.unpackbits(self.planes[level][first // 8 : (first + PARTED_IDS) // 8], count=len(part)).view(bool)
                zeros, ones = np.flatnonzero(~ones), np.flatnonzero(ones)
                part[zeros] = now[low : low + len(zeros)]
                part[ones] = now[high : high + len(ones)]
                low, high = low + len(zeros), high + len(ones)
            now, above = above, now
        return now

    @classmethod
    def load(cls, row: dict) -> WaveletMatrix:
        """From a row of a shard file."""
        return cls(
            row["n_tokens"],
            row["width"],
            [np.frombuffer(x, np.uint8) for x in row["planes"]],
            [np.frombuffer(x, "<u8") for x in row["ranks"]],
        )


def _shard(part: int, seq: int, ids: list[bytes], docs: list[int | None], kind: str, width: int) -> pa.RecordBatch:
    tokens = np.frombuffer(b"".join(ids), kind)
    matrix = WaveletMatrix.build(tokens, width)
    size = np.dtype(kind).itemsize
    return pa.RecordBatch.from_pydict(
        {
            "part": pa.array([part], pa.int32()),
            "seq": pa.array([seq], pa.int32()),
            "n_tokens": pa.array([len(tokens)], pa.int64()),
            "width": pa.array([width], pa.int32()),
            "planes": pa.array([[x.tobytes() for x in matrix.planes]], pa.list_(pa.binary())),
            "ranks": pa.array([[x.tobytes() for x in matrix.ranks]], pa.list_(pa.binary())),
            "doc_ids": pa.array([docs], pa.list_(pa.int64())),
            "lengths": pa.array([[len(x) // size for x in ids]], pa.list_(pa.int64())),
        }
    )


def write_token_shards(
    docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int = 0, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode ``docs(doc_id, text)`` and write one wavelet file per shard under ``path``.

    Documents are laid out by range of ``doc_id`` and encoded in order; a shard
    is closed by the document that brings it to ``shard_tokens``, so a document
    is never cut and one longer than a shard has a shard of its own.  A null
    text is an empty one (its only id is ``end_id``).  A null ``doc_id`` sorts
    first; rows with equal ids are all kept, in the order of their texts.  Other
    columns are ignored.
    """
    ship(docs.sparkSession)
    kind, width = ("<u2", 16) if vocabulary <= 1 << 16 else ("<u4", 32)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, size = TaskContext.get().partitionId(), 0, 0
        encode, end = encoder(tokenizer, kind, CACHE_PIECES), np.array([end_id], kind).tobytes()
        ids: list[bytes] = []
        keys: list[int | None] = []
        for batch in batches:
            for doc_id, found in zip(batch.column(0).to_pylist(), encode.all_ids(batch.column(1))):
                ids.append(found + end)
                keys.append(doc_id)
                size += len(ids[-1])
                if size >= shard_tokens * len(end):
                    yield _shard(part, seq, ids, keys, kind, width)
                    ids, keys, seq, size = [], [], seq + 1, 0
        if ids:
            yield _shard(part, seq, ids, keys, kind, width)

    (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(encoded, SHARD_SCHEMA)
        .write.option("maxRecordsPerFile", 1)
        .option("compression", "zstd")
        .parquet(path)
    )


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shard rows; columns that are not selected are not read."""
    ship(spark)
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, seq, start): ids before each shard, by a running sum inside each part and over the parts.

    There are as many parts as the layout had partitions, which bounds the
    window over them.
    """
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    return sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part").select(
        "part", "seq", (F.col("before") + F.col("inside")).alias("start")
    )


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document of each shard: place in the shard, count and checksum of the ids read from the planes."""
    for batch in batches:
        for row in range(batch.num_rows):
            shard = batch.slice(row, 1).to_pydict()
            shard = {k: v[0] for k, v in shard.items()}
            ids = memoryview(WaveletMatrix.load(shard).all_ids().astype("<u4")).cast("B")
            lengths = np.array(shard["lengths"], np.int64)
            ends = np.cumsum(lengths)
            sums = [zlib.crc32(ids[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([shard["part"]] * len(sums), pa.int32()),
                    "seq": pa.array([shard["seq"]] * len(sums), pa.int32()),
                    "doc_id": pa.array(shard["doc_ids"], pa.int64()),
                    "inside": pa.array(ends - lengths),
                    "n_tokens": pa.array(lengths),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
            )


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shard files alone."""
    shards = read_shards(spark, path)
    docs = shards.mapInArrow(digests, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return docs.join(shard_starts(shards), ["part", "seq"]).select(
        "doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(part, seq, n, first, last): how often an id occurs in each shard that has it, and where first and last."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for shard in batch.to_pylist():
                matrix = WaveletMatrix.load(shard)
                n = matrix.rank(token, matrix.size)
                if n:
                    found.append(
                        {"part": shard["part"], "seq": shard["seq"], "n": n}
                        | {"first": matrix.select(token, 0), "last": matrix.select(token, n - 1)}
                    )
            if found:
                yield pa.RecordBatch.from_pylist(
                    found, pa.schema([("part", pa.int32()), ("seq", pa.int32()), *((k, pa.int64()) for k in ("n", "first", "last"))])
                )

    return read_shards(spark, path).select("part", "seq", "n_tokens", "width", "planes", "ranks").mapInArrow(
        look, "part int, seq int, n long, first long, last long"
    )


def shard_tokens_digests(docs: DataFrame, tokenizer: str, vocabulary: int, **options: int) -> DataFrame:
    """Write the shards to the shared folder, read them back and digest them."""
    path = scratch_path(docs.sparkSession, "token-shards")
    write_token_shards(docs, path, tokenizer, vocabulary, **options)
    return token_digests(docs.sparkSession, path)
