"""Packing token pieces into sequences: best-fit decreasing, certified by lower bounds, repacked where a gap is left."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheetlake.llm.chosenpath import by_key, rows_by_key
from sheetlake.llm.encode import encoder
from sheetlake.llm.ship import ship
from sheetlake.session import written

SEQUENCE = 4096
PART_ROWS = 32_768
BINS_PER_PART = 1 << 24
#: Fewer than the encoder's default: the packing comes last in a pipeline, beside what other steps left in the workers.
CACHED = 150_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, row long, part long, bin long, offset long, bins long, bound long, loosest boolean"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, limit: int = SEQUENCE) -> DataFrame:
    """Encode whole texts and cut them into pieces of ``limit`` ids; the last may be shorter.

    A null text is an empty one, whose only id is ``end_id``.
    """
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, cached=CACHED), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode.all_ids(batch.column(1))):
                ids += end
                for first in range(0, len(ids), 4 * limit):
                    some = ids[first : first + 4 * limit]
                    out.append((doc_id, first // (4 * limit), first // 4, len(some) // 4, zlib.crc32(some)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def lower_bound(counts: np.ndarray, limit: int) -> int:
    """The best bound on the number of bins that two families of dual feasible functions give.

    ``counts[w]`` items have the size ``w``.  The first family, for each
    a <= limit / 2, counts sizes over limit - a as whole bins and drops sizes below a;
    the second, for each k, rounds a size down to a multiple of a k-th of a bin, where
    it is counted in steps of one (k + 1)-th.
    """
    sizes = np.arange(limit + 1)
    volume = np.concatenate([[0], np.cumsum(counts * sizes)])
    number = np.concatenate([[0], np.cumsum(counts)])
    best = -(-int(volume[-1]) // limit)
    for a in range(1, limit // 2 + 1):
        large = int(number[-1] - number[limit - a + 1])
        middle = int(volume[limit - a + 1] - volume[a])
        best = max(best, large - (-middle // limit))
    for k in range(1, 33):
        steps, rest = np.divmod((k + 1) * sizes, limit)
        exact = int((counts * sizes)[rest == 0].sum())
        rounded = int((counts * steps)[rest != 0].sum())
        best = max(best, -(-(exact * k + rounded * limit) // (k * limit)))
    return best


def best_fit(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, given in descending order: each goes to the fullest bin that takes it."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(limit + 1)]
    open_sizes = 0
    opened = 0
    for k, length in enumerate(lengths.tolist()):
        fitting = open_sizes >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = free[room].pop()
            if not free[room]:
                open_sizes &= ~(1 << room)
        else:
            room, chosen, opened = limit, opened, opened + 1
        bins[k], offsets[k] = chosen, limit - room
        left = room - length
        if left:
            free[left].append(chosen)
            open_sizes |= 1 << left
    return bins, offsets


def _packer(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows_by_key(batches, "part"):
            part = part.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
            lengths = part.column("length").to_numpy()
            bins, offsets = best_fit(lengths, limit)
            fill = np.bincount(bins, weights=lengths).astype(np.int64)
            bound = lower_bound(np.bincount(lengths, minlength=limit + 1), limit)
            n = len(lengths)
            for name, values in (
                ("bin", bins),
                ("offset", offsets),
                ("bins", np.full(n, len(fill))),
                ("bound", np.full(n, bound)),
                ("loosest", bins == int(fill.argmin())),
            ):
                part = part.append_column(name, pa.array(values))
            yield from part.combine_chunks().to_batches()

    return pack


def _dealt(rows: DataFrame, n: int, first_part: int, limit: int) -> DataFrame:
    """Deal rows to parts of about ``PART_ROWS`` by their numbers, whatever ids they share, and pack each part."""
    parts = max(1, math.ceil(n / PART_ROWS))
    order = F.pmod(F.xxhash64("row", F.lit(first_part)), F.lit(parts))
    keyed = rows.select("doc_id", "piece", "start", "length", "ids_crc32", "row", (order + first_part).cast("long").alias("part"))
    return written(by_key(keyed, "part", _packer(limit), PACKED), "packed")


def pack(pieces: DataFrame, limit: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece in a sequence of at most ``limit``.

    Parts are packed on their own.  A part whose bin count is its lower bound is
    certified.  Parts with a gap pool all their pieces, certified parts
    those of their emptiest bin; the pool is dealt anew and packed again, as
    long as that saves bins and the bound of the whole table is not met.  Only counts reach the driver.
    """
    return rounds(pieces, limit)[0].select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("part") * BINS_PER_PART + F.col("bin")).alias("sequence_id"),
        "offset",
    )


def rounds(pieces: DataFrame, limit: int = SEQUENCE) -> tuple[DataFrame, list[int]]:
    """The packed pieces, and the number of bins after each round."""
    ship(pieces.sparkSession)
    # Numbers are written with the pieces, so every round deals the same rows.
    pieces = written(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    total = pieces.count()
    sizes = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(limit + 1, np.int64)
    for row in sizes:
        counts[row.length] = row.n
    goal = lower_bound(counts, limit)
    packed = _dealt(pieces, total, 0, limit)
    next_part = max(1, math.ceil(total / PART_ROWS))
    history: list[int] = []
    while True:
        parts = packed.groupBy("part").agg(F.max("bins").alias("bins"), F.max("bound").alias("bound"))
        state = parts.agg(F.coalesce(F.sum("bins"), F.lit(0)).alias("bins"), F.count(F.lit(1)).alias("parts")).head()
        history.append(state.bins)
        if state.bins <= goal or state.parts < 2:
            break
        moves = (F.col("bins") > F.col("bound")) | F.col("loosest")
        movers = packed.where(moves)
        before = movers.select("part", "bin").distinct().count()
        n = movers.count()
        again = _dealt(movers, n, next_part, limit)
        after = again.select("part", "bin").distinct().count()
        if after >= before:
            break
        rest = packed.where(~moves)
        # One bin, its emptiest, left a part that keeps others; none where it had left before.
        lost = movers.groupBy("part").agg(F.lit(1).alias("lost"))
        left = rest.groupBy("part").agg(F.max("bins").alias("bins"), F.max("bound").alias("bound")).join(lost, "part", "left")
        left = left.select("part", (F.col("bins") - F.coalesce("lost", F.lit(0))).alias("bins"), "bound")
        rest = rest.drop("bins", "bound").join(left, "part").withColumn("loosest", F.lit(False))
        packed = written(rest.select(again.columns).unionByName(again), "packed")
        next_part += max(1, math.ceil(n / PART_ROWS))
    return packed, history


def packed_sequences(docs: DataFrame, tokenizer: str, end_id: int = 1, limit: int = SEQUENCE) -> DataFrame:
    """Cut and pack all rows of ``docs(doc_id, text)``; other columns are ignored.

    Rows with a null or repeated ``doc_id`` are packed like any other.  An empty
    table gives no rows.
    """
    return pack(cut_pieces(docs, tokenizer, end_id, limit), limit)
