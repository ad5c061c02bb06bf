"""Exact nearest vectors by squared Euclidean distance."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from sheetlake.functions import fixed
from sheetlake.operators.topn import first_n

# The task functions below travel with the plan, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Numbers in a batch of queries that may be sent to every task (32 MB of doubles).
MAX_QUERY_VALUES = 4_000_000
# Bytes of doubles in a block of queries, in a block of vectors, and in all matrices of one tile of both.
QUERY_BLOCK_BYTES = 16 << 20
VECTOR_BLOCK_BYTES = 64 << 20
TILE_BYTES = 32 << 20


def vector_store_check(vectors: DataFrame, dimension: int | None = None) -> DataFrame:
    """One row per vector length: count, null entries, whether it is the norm.

    The norm is the given dimension or else the most frequent length.
    """
    embedding = F.col("embedding")
    holes = F.exists(embedding, lambda x: x.isNull() | F.isnan(x))
    lengths = vectors.groupBy(F.coalesce(F.size(embedding), F.lit(-1)).alias("dimension")).agg(
        F.count("*").alias("n_vectors"),
        F.count_if(embedding.isNull()).alias("n_null"),
        F.count_if(holes).alias("n_with_holes"),
    )
    norm = (
        lengths.agg(F.max_by("dimension", F.struct("n_vectors", "dimension"))).scalar()
        if dimension is None
        else F.lit(dimension)
    )
    return lengths.withColumn("is_valid", (F.col("dimension") == norm) & (F.col("dimension") > 0))


def vector_table(vectors: DataFrame, dimension: int) -> DataFrame:
    """The vectors that can be searched: right length, no holes, as floats."""
    embedding = F.col("embedding").cast("array<float>")
    whole = ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x))
    return vectors.select("id", embedding.alias("embedding")).filter(
        (F.size("embedding") == dimension) & whole
    )


def _matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def tile_sizes(dimension: int) -> tuple[int, int]:
    """Queries and vectors of a tile: both sides and their product stay inside the budget."""
    side = max(1, TILE_BYTES // 4 // (8 * dimension))
    vectors = min(4_096, side)
    return max(1, min(TILE_BYTES // 2 // (8 * vectors), side)), vectors


class _Nearest:
    """Running k nearest of a block of queries over batches of vectors, tile by tile."""

    def __init__(self, queries: np.ndarray, k: int):
        self.k = k
        self.tile, self.step = tile_sizes(queries.shape[1])
        self.tiles = [queries[i : i + self.tile] for i in range(0, len(queries), self.tile)]
        self.norms = [(q**2).sum(axis=1) for q in self.tiles]
        self.best: list[tuple[np.ndarray, np.ndarray, np.ndarray] | None] = [None] * len(self.tiles)
        self.limits = [np.full(len(q), np.inf) for q in self.tiles]

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for first in range(0, len(ids), self.step):
            some = vectors[first : first + self.step]
            lengths = (some**2).sum(axis=1)
            for t in range(len(self.tiles)):
                self._add(t, ids[first : first + self.step], some, lengths)

    def _add(self, t: int, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray) -> None:
        # One product finds the candidates; their distances are then taken
        # directly, so that equal vectors tie exactly.
        queries, norms = self.tiles[t], self.norms[t]
        rough = queries @ vectors.T
        rough *= -2.0
        rough += lengths[None, :]
        rough += norms[:, None]
        limit = self.limits[t]
        if len(ids) > self.k:
            limit = np.minimum(limit, np.partition(rough, self.k - 1, axis=1)[:, self.k - 1])
        slack = 1e-9 * (lengths.max() + norms + 1.0)
        q, v = np.nonzero(rough <= (limit + slack)[:, None])
        del rough
        room = max(1, TILE_BYTES // (8 * queries.shape[1]))
        for first in range(0, len(q), room):
            some_q, some_v = q[first : first + room], v[first : first + room]
            distances = ((vectors[some_v] - queries[some_q]) ** 2).sum(axis=1)
            self._merge(t, some_q, distances, ids[some_v])

    def _merge(self, t: int, q: np.ndarray, distances: np.ndarray, ids: np.ndarray) -> None:
        if self.best[t] is not None:
            q, distances, ids = (np.concatenate(x) for x in zip(self.best[t], (q, distances, ids)))
        order = np.lexsort((ids, distances, q))
        q, distances, ids = q[order], distances[order], ids[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        last = place == self.k - 1
        self.limits[t][q[last]] = distances[last]
        self.best[t] = q[keep], distances[keep], ids[keep]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [(t * self.tile + x[0], x[2], x[1]) for t, x in enumerate(self.best) if x is not None]
        if not found:
            return np.array([], dtype=int), np.array([]), np.array([])
        q, ids, distances = (np.concatenate(x) for x in zip(*found))
        return q, ids, distances


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist())


def usual_dimension(vectors: DataFrame) -> int | None:
    """The most frequent length of the stored vectors, the larger one on ties."""
    lengths = vectors.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).filter(F.col("d") > 0)
    return lengths.agg(F.max_by("d", F.struct("n", "d"))).head()[0]


def unsearchable(vectors: DataFrame, dimension: int, key: str = "id") -> DataFrame:
    """``(id, reason)`` of the vectors that a search can't use: missing, of another length, or with holes."""
    embedding = F.col("embedding")
    reason = (
        F.when(embedding.isNull(), "missing")
        .when(F.size(embedding) != dimension, "length")
        .when(F.exists(embedding, lambda x: x.isNull() | F.isnan(x)), "holes")
    )
    return vectors.select(F.col(key), reason.alias("reason")).filter(F.col("reason").isNotNull())


def knn_l2(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = fixed.TOP_K,
    dimension: int | None = None,
    skip_unsearchable: bool = False,
) -> DataFrame:
    """The k nearest vectors ``(id, embedding)`` of every query, nearest first.

    Queries are ``(query_id, embedding)``.  Distances are squared; ties go to
    the lower id.  The dimension is the given one or else the stored vectors'
    usual length.  A vector or query that can't be used stops the search, unless they are to be
    skipped; ``unsearchable`` lists them.  Each task keeps the k nearest of its own vectors, so no pair
    beyond those is ever written or shuffled.  A small batch of queries goes to
    every task; a larger one is cut into blocks that meet blocks of vectors.
    """
    kinds = dict(queries.dtypes)["query_id"], dict(vectors.dtypes)["id"]
    schema = f"query_id {kinds[0]}, id {kinds[1]}, distance double"
    dimension = dimension or usual_dimension(vectors)
    if dimension is None:
        empty = f"query_id {kinds[0]}, rank int, id {kinds[1]}, distance double"
        return queries.sparkSession.createDataFrame([], empty)
    if not skip_unsearchable:
        for frame, key in ((vectors, "id"), (queries, "query_id")):
            bad = unsearchable(frame, dimension, key)
            if not bad.isEmpty():
                raise ValueError(f"{bad.count()} rows of {key} are no vectors of length {dimension}; see unsearchable()")
    usable = vector_table(vectors, dimension)
    asked = vector_table(queries.withColumnRenamed("query_id", "id"), dimension).withColumnRenamed(
        "id", "query_id"
    )
    most = max(1, MAX_QUERY_VALUES // dimension)
    table = asked.limit(most + 1).toArrow()
    if table.num_rows <= most:
        local = _nearest_by_task(usable, table, k, dimension, schema)
    else:
        local = _nearest_by_block(usable, asked, k, dimension, schema)
    ranked = first_n(local, ["query_id"], [F.asc("distance"), F.asc("id")], k)
    return ranked.select("query_id", "rank", "id", "distance")


def _nearest_by_task(vectors: DataFrame, table: pa.Table, k, dimension, schema) -> DataFrame:
    spark = vectors.sparkSession
    if not table.num_rows:
        return spark.createDataFrame([], schema)
    names = table.column("query_id").combine_chunks()
    block = spark.sparkContext.broadcast((names, _matrix(table.column("embedding"), dimension)))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_names, matrix = block.value
        search = _Nearest(matrix, k)
        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            search.add(_ids(batch.column("id")), _matrix(batch.column("embedding"), dimension))
        q, ids, distances = search.rows()
        if len(q):
            yield pa.RecordBatch.from_arrays(
                [query_names.take(pa.array(q)), pa.array(ids.tolist(), kind), pa.array(distances, pa.float64())],
                names=["query_id", "id", "distance"],
            )

    return vectors.mapInArrow(nearest, schema)


def _nearest_by_block(vectors: DataFrame, queries: DataFrame, k, dimension, schema) -> DataFrame:
    """Blocks of queries meet blocks of vectors, each pair of blocks in one task; a block has so many bytes."""
    block_vectors = max(1, VECTOR_BLOCK_BYTES // (8 * dimension))
    block_queries = max(1, QUERY_BLOCK_BYTES // (8 * dimension))
    n_vectors = max(1, -(-vectors.count() // block_vectors))
    n_queries = max(1, -(-queries.count() // block_queries))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = vectors.withColumn("v", F.pmod(F.xxhash64("id"), F.lit(n_vectors)).cast("int")).withColumn(
        "q", every(n_queries)
    )
    right = queries.withColumn("q", F.pmod(F.xxhash64("query_id"), F.lit(n_queries)).cast("int")).withColumn(
        "v", every(n_vectors)
    )

    def nearest(left_table: pa.Table, right_table: pa.Table) -> pa.Table:
        names = right_table.column("query_id").combine_chunks()
        search = _Nearest(_matrix(right_table.column("embedding"), dimension), k)
        for batch in left_table.to_batches(max_chunksize=16_384):
            search.add(_ids(batch.column("id")), _matrix(batch.column("embedding"), dimension))
        q, ids, distances = search.rows()
        kind = left_table.schema.field("id").type
        return pa.table(
            {
                "query_id": names.take(pa.array(q, pa.int64())),
                "id": pa.array(ids.tolist(), kind),
                "distance": pa.array(distances, pa.float64()),
            }
        )

    return left.groupBy("v", "q").cogroup(right.groupBy("v", "q")).applyInArrow(nearest, schema)
