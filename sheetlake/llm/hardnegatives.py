"""Hard negatives by inner products, with coordinate pruning in buckets of similar length.

Vectors are laid out by falling length and cut into buckets.  A bucket holds its
vectors and, for every coordinate, its rows in the order of that coordinate of
their directions.  An anchor that looks for scores of at least t asks a bucket of
lengths up to l for cosines of at least t / (l * its own length): too much for a direction
means that the bucket is skipped; else each of the anchor's focus coordinates (the largest of its
direction) bounds the same coordinate of every feasible direction.  The sorted
lists give the rows within these ranges, their intersection is verified by exact integer
products, and t rises with what was found.  Nothing is estimated: the result is that of a full comparison.

Blocks of anchors meet groups of buckets in a shuffle, so that no task holds more than one of each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from sheetlake.llm.chosenpath import by_key, rows_by_key
from sheetlake.llm.scratch import Scratch
from sheetlake.llm.ship import ship
from sheetlake.operators.topn import first_n
from sheetlake.session import written

BUCKET_ROWS = 2048
#: Within a bucket the shortest vector has at least this share of the longest one's length.
ALIKE = 0.9
GROUP_ROWS = 8 * BUCKET_ROWS
BLOCK_ANCHORS = 1000
FOCUS = 3
SLACK = 1e-9

FIRST = 5
LOW, HIGH = 80, 100

ROWS = "vec_id long, label long, twin long, dim int, length double, vector binary"
HELD = (
    "part long, dim int, top double, ids binary, labels binary, twins binary, kind string, data binary, extra binary"
)
SCORED = "anchor_id long, anchor_twin long, slot int, found_id long, found_twin long, score long"


def usable(vector: Column) -> Column:
    """Whether a vector is there, has components, and all of them are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector's components times 256, rounded down, with its length."""
    for batch in batches:
        lists = batch.column(2)
        values = np.floor(256.0 * lists.flatten().to_numpy())
        ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
        vectors = np.split(values, ends[:-1]) if len(ends) else []
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                batch.column(3),
                pa.array([len(x) for x in vectors], pa.int32()),
                pa.array([_length(x) for x in vectors], pa.float64()),
                pa.array([x.tobytes() for x in vectors], pa.binary()),
            ],
            ["vec_id", "label", "twin", "dim", "length", "vector"],
        )


def _length(vector: np.ndarray) -> float:
    return math.hypot(*vector.tolist())


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """The rows that take part: vec_id, label as it counts, integer vector and its length.

    ``twin`` tells rows of one ``vec_id`` apart by their content.
    """
    vec_id, vector = F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    label = F.col("label").cast("long")
    rows = embeddings.where(vec_id.isNotNull() & label.isNotNull() & usable(vector)).select(
        vec_id.alias("vec_id"),
        F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        vector.alias("vector"),
        F.xxhash64(label, vector).alias("twin"),
    )
    return rows.mapInArrow(_whole, ROWS)


def _narrow(values: np.ndarray) -> tuple[str, bytes]:
    """The values in the smallest type that holds them."""
    for kind in ("<i2", "<i4"):
        if not values.size or np.abs(values).max() <= np.iinfo(kind).max:
            return kind, values.astype(kind).tobytes()
    return "<f8", values.astype("<f8").tobytes()


class Vectors:
    """Rows of one dimension: a bucket, or a block of anchors."""

    def __init__(self, dim: int, ids: bytes, labels: bytes, twins: bytes, kind: str, data: bytes, extra: bytes) -> None:
        self.ids, self.labels, self.twins = (np.frombuffer(x, "<i8") for x in (ids, labels, twins))
        self.values = np.frombuffer(data, kind).astype(np.float64).reshape(-1, dim)
        self.lengths = np.sqrt((self.values**2).sum(axis=1))
        self.units = self.values / np.maximum(self.lengths, 1e-300)[:, None]
        self.extra = extra

    @classmethod
    def of(cls, row: dict) -> Vectors:
        return cls(*(row[x] for x in ("dim", "ids", "labels", "twins", "kind", "data", "extra")))


class Bucket(Vectors):
    """Vectors of similar length with a sorted list per coordinate."""

    def __init__(self, *parts: object) -> None:
        super().__init__(*parts)
        n = len(self.ids)
        self.order = np.frombuffer(self.extra, "<i2").reshape(-1, n)
        self.sorted = np.take_along_axis(self.units.T, self.order.astype(np.int64), axis=1)
        self.top = float(self.lengths.max(initial=0.0))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of both.  One that does not fit 64 bits is an error."""
    bound = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if bound < 2**53:
        return (left @ right.T).astype(np.int64)
    exact = [[int(x) for x in row] for row in left.tolist()], [[int(x) for x in row] for row in right.tolist()]
    return np.array([[sum(map(int.__mul__, a, b)) for b in exact[1]] for a in exact[0]], np.int64).reshape(len(left), -1)


def feasible(units: np.ndarray, focus: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest value that a direction with a cosine of at least ``least`` can have in the focus coordinates."""
    own = np.clip(np.take_along_axis(units, focus, axis=1), -1, 1)
    turn = np.arccos(np.clip(least, -1, 1))[:, None]
    place = np.arccos(own)
    low, high = np.cos(np.minimum(place + turn, np.pi)), np.cos(np.maximum(place - turn, 0))
    return low - SLACK, high + SLACK


def candidates(bucket: Bucket, anchors: Vectors, focus: np.ndarray, least: np.ndarray) -> tuple[list[np.ndarray | None], int]:
    """For each anchor the rows that can reach a score of ``least`` (None: all of them), and how many lists were cut.

    A negative or infinite ``least`` prunes nothing or everything.
    """
    n = len(bucket.ids)
    reach = anchors.lengths * bucket.top
    found: list[np.ndarray | None] = [None] * len(anchors.ids)
    out = (least > reach * (1 + SLACK) + SLACK) & (least > 0)
    for k in np.flatnonzero(out):
        found[k] = np.zeros(0, np.int64)
    asked = np.flatnonzero(~out & (least >= 0) & (reach > 0))
    if not len(asked):
        return found, int(out.sum())
    low, high = feasible(anchors.units[asked], focus[asked], least[asked] / reach[asked] - SLACK)
    first, last = np.zeros(low.shape, np.int64), np.zeros(low.shape, np.int64)
    for c in np.unique(focus[asked]):
        mine = focus[asked] == c
        first[mine] = np.searchsorted(bucket.sorted[c], low[mine], "left")
        last[mine] = np.searchsorted(bucket.sorted[c], high[mine], "right")
    shortest = np.argmin(last - first, axis=1)
    cut = 0
    for k, a in enumerate(asked.tolist()):
        s = shortest[k]
        if 2 * (last[k, s] - first[k, s]) >= n:
            continue
        rows = bucket.order[focus[a, s], first[k, s] : last[k, s]].astype(np.int64)
        for other in range(focus.shape[1]):
            if other != s and len(rows):
                x = bucket.units[rows, focus[a, other]]
                rows = rows[(x >= low[k, other]) & (x <= high[k, other])]
        found[a] = rows
        cut += 1
    return found, cut + int(out.sum())


class Best:
    """The first ``FIRST`` rows by score, id and twin of any number of keys."""

    def __init__(self, keys: int) -> None:
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]
        self.worst = np.full(keys, np.iinfo(np.int64).min)

    def offer(self, key: np.ndarray, ids: np.ndarray, twins: np.ndarray, score: np.ndarray) -> None:
        keep = score >= self.worst[key]
        if not keep.any():
            return
        key, ids, twins, score = (
            np.concatenate([old, new[keep]]) for old, new in zip(self.rows, (key, ids, twins, score))
        )
        order = np.lexsort((twins, ids, -score, key))
        key = key[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        rank = np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key))))
        order, key, rank = order[rank < FIRST], key[rank < FIRST], rank[rank < FIRST]
        self.rows = [key, ids[order], twins[order], score[order]]
        full = rank == FIRST - 1
        self.worst[key[full]] = self.rows[3][full]


def _scores(bucket: Bucket, anchors: Vectors, found: list[np.ndarray | None]) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, row, score) of all candidates."""
    dense = np.array([k for k, x in enumerate(found) if x is None], np.int64)
    if len(dense):
        scores = products(anchors.values[dense], bucket.values)
        yield np.repeat(dense, len(bucket.ids)), np.tile(np.arange(len(bucket.ids)), len(dense)), scores.ravel()
    some = [(k, x) for k, x in enumerate(found) if x is not None and len(x)]
    if some:
        scores = [products(anchors.values[k : k + 1], bucket.values[x])[0] for k, x in some]
        yield (
            np.concatenate([np.full(len(x), k) for k, x in some]),
            np.concatenate([x for _, x in some]),
            np.concatenate(scores),
        )


def _focus(anchors: Vectors) -> np.ndarray:
    return np.argsort(-np.abs(anchors.units), axis=1, kind="stable")[:, :FOCUS]


def best_positives(anchors: Vectors, buckets: list[Bucket]) -> Best:
    """Of each anchor the first rows of its label but itself."""
    best, focus = Best(len(anchors.ids)), _focus(anchors)
    for bucket in buckets:
        least = best.worst.astype(np.float64)
        found, _ = candidates(bucket, anchors, focus, least)
        for anchor, row, score in _scores(bucket, anchors, found):
            own = (bucket.ids[row] == anchors.ids[anchor]) & (bucket.twins[row] == anchors.twins[anchor])
            keep = (bucket.labels[row] == anchors.labels[anchor]) & ~own
            anchor, row, score = anchor[keep], row[keep], score[keep]
            best.offer(anchor, bucket.ids[row], bucket.twins[row], score)
    return best


def best_negatives(anchors: Vectors, buckets: list[Bucket]) -> Best:
    """Of each anchor and positive (key: anchor * FIRST + slot) the first rows of another label within its range."""
    best, focus = Best(len(anchors.ids) * FIRST), _focus(anchors)
    wanted = np.frombuffer(anchors.extra, "<i8").reshape(-1, FIRST)
    # A negative positive score has no range.
    some = wanted >= 0
    floor = -((-LOW * wanted) // HIGH)
    for bucket in buckets:
        lowest = np.where(some, np.maximum(floor, best.worst.reshape(-1, FIRST)).astype(np.float64), np.inf)
        found, _ = candidates(bucket, anchors, focus, lowest.min(axis=1))
        for anchor, row, score in _scores(bucket, anchors, found):
            keep = bucket.labels[row] != anchors.labels[anchor]
            anchor, row, score = anchor[keep], row[keep], score[keep]
            for slot in range(FIRST):
                fits = some[anchor, slot] & (score >= floor[anchor, slot]) & (score <= wanted[anchor, slot])
                a, r = anchor[fits], row[fits]
                best.offer(a * FIRST + slot, bucket.ids[r], bucket.twins[r], score[fits])
    return best


def _held(part: int, rows: list[pa.RecordBatch], sort: bool) -> pa.RecordBatch:
    """One row that holds many of one dimension; with sorted lists, or with the anchors' positive scores."""
    table = pa.Table.from_batches(rows)
    dim = table.column("dim")[0].as_py()
    values = np.frombuffer(b"".join(table.column("vector").to_pylist()), "<f8").reshape(-1, dim)
    kind, data = _narrow(values)
    if sort:
        lengths = np.sqrt((values**2).sum(axis=1))
        extra = np.argsort(values / np.maximum(lengths, 1e-300)[:, None], axis=0, kind="stable").T.astype("<i2").tobytes()
    else:
        wanted = table.column("wanted").to_pylist() if "wanted" in table.column_names else []
        extra = np.array(wanted, "<i8").tobytes()
    packed = {x: table.column(x).to_numpy().astype("<i8").tobytes() for x in ("vec_id", "label", "twin")}
    return pa.RecordBatch.from_pydict(
        {
            "part": pa.array([part], pa.int64()),
            "dim": pa.array([dim], pa.int32()),
            "top": pa.array([max(table.column("length").to_pylist())], pa.float64()),
            "ids": pa.array([packed["vec_id"]], pa.binary()),
            "labels": pa.array([packed["label"]], pa.binary()),
            "twins": pa.array([packed["twin"]], pa.binary()),
            "kind": [kind],
            "data": pa.array([data], pa.binary()),
            "extra": pa.array([extra], pa.binary()),
        }
    )


def _holder(rows: int, alike: float, sort: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows that follow each other, held together up to a number, of one dimension and similar lengths; equal rows once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size, last, dim, longest = 0, None, 0, 0.0
        for batch in batches:
            first = 0
            for k, key in enumerate(zip(*(batch.column(x).to_pylist() for x in (0, 2, 3, 4)))):
                vec_id, twin, own, length = key
                again = last == (vec_id, twin)
                full = size and (size == rows or own != dim or length < alike * longest)
                if again or full:
                    held.append(batch.slice(first, k - first))
                    first = k + 1 if again else k
                if again:
                    continue
                if full:
                    yield _held(part, held, sort)
                    part, held, size = part + 1, [], 0
                if not size:
                    dim, longest = own, length
                last, size = (vec_id, twin), size + 1
            held.append(batch.slice(first))
        if size:
            yield _held(part, held, sort)

    return work


def length_buckets(rows: DataFrame) -> DataFrame:
    """Buckets of all rows by falling length; one row each."""
    order = ["dim", F.desc("length"), "vec_id", "twin"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _holder(BUCKET_ROWS, ALIKE, True), HELD
    )


def anchor_blocks(rows: DataFrame, parts: int) -> DataFrame:
    """Anchors in blocks, dealt to so many parts; one row each."""
    return rows.repartition(parts, "vec_id", "twin").sortWithinPartitions("dim", "vec_id", "twin").mapInArrow(
        _holder(2 * BLOCK_ANCHORS, 0.0, False), HELD
    )


def _meeting(find: Callable[[Vectors, list[Bucket]], Best]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compare the anchors of each unit with its buckets, longest first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in rows_by_key(batches, "unit"):
            unit = unit.sort_by([("top", "descending"), ("part", "ascending")]).to_pylist()
            for row in (x for x in unit if x["anchor"]):
                anchors = Vectors.of(row)
                best = find(anchors, [Bucket.of(x) for x in unit if not x["anchor"] and x["dim"] == row["dim"]])
                key, ids, twins, score = best.rows
                slots = FIRST if find is best_negatives else 1
                names = ("anchor_id", "anchor_twin", "slot", "found_id", "found_twin", "score")
                columns = (anchors.ids[key // slots], anchors.twins[key // slots], key % slots, ids, twins, score)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names)

    return work


def _numbers(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _met(blocks: DataFrame, buckets: DataFrame, n_blocks: int, n_groups: int, find: Callable) -> DataFrame:
    """All blocks of anchors against all buckets: a unit is one part of the anchors and one group of buckets."""
    left = blocks.select(
        "*",
        F.shiftright("part", 32).alias("_block"),
        _numbers(n_groups).alias("_group"),
        F.lit(True).alias("anchor"),
    )
    right = buckets.select(
        "*",
        _numbers(n_blocks).alias("_block"),
        F.pmod(F.xxhash64("part"), F.lit(n_groups)).alias("_group"),
        F.lit(False).alias("anchor"),
    )
    units = left.unionByName(right).withColumn("unit", F.col("_group") * n_blocks + F.col("_block"))
    return by_key(units.drop("_group", "_block"), "unit", _meeting(find), SCORED)


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score over ``embeddings(vec_id, embedding, label)``.

    Rows without an id, label or vector, and those with a component that is null or not
    finite, take no part; vectors of different dimensions have no score with each
    other.  Rows that repeat id, label and vector count once; other rows of one id are rows of their own, and their
    ties go by a hash of their content.  A score that does not fit 64 bits is an error.  Other columns
    are ignored; an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    ship(spark)
    rows = whole_vectors(embeddings)
    is_anchor = F.col("vec_id") % 100 == 0
    size = embeddings.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(is_anchor.cast("int")), F.lit(0)).alias("anchors")
    ).head()
    n_blocks = max(1, math.ceil(size.anchors / BLOCK_ANCHORS))
    n_groups = max(1, math.ceil(size.rows / GROUP_ROWS))
    anchors = rows.where(is_anchor)
    with Scratch(spark) as scratch:
        buckets = scratch.written(length_buckets(rows), "buckets")
        blocks = scratch.written(anchor_blocks(anchors, n_blocks), "anchors")
        near = scratch.written(_met(blocks, buckets, n_blocks, n_groups, best_positives), "near")
        order = [F.desc("score"), F.asc("found_id"), F.asc("found_twin")]
        positives = written(
            first_n(near.drop("slot"), ["anchor_id", "anchor_twin"], order, FIRST)
            .withColumn("slot", (F.col("rank") - 1).cast("int"))
            .select("anchor_id", "anchor_twin", "slot", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")),
            "positives",
        )
        scores = positives.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_twin").alias("twin")).agg(
            F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("_scores")
        )
        none = F.array_repeat(F.lit(-1).cast("long"), FIRST)
        wanted = F.slice(F.concat(F.col("_scores.positive_score"), none), 1, FIRST)
        asking = anchors.join(scores, ["vec_id", "twin"]).select(*anchors.columns, wanted.alias("wanted"))
        blocks = scratch.written(anchor_blocks(asking, n_blocks), "asking")
        found = written(_met(blocks, buckets, n_blocks, n_groups, best_negatives), "negatives")
    best = first_n(found, ["anchor_id", "anchor_twin", "slot"], order, FIRST)
    return best.join(positives, ["anchor_id", "anchor_twin", "slot"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("found_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
