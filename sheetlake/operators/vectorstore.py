"""Stored vectors in blocks with a ball around each, searched exactly.

Vectors are dealt to the nearest of a bounded number of pivots; those of one pivot are cut into
blocks of bounded size.  A block is one stored row: its vectors, their centre, and the radius that
holds them all.  A query first searches the blocks with the nearest centres.  The k-th distance found there
rules out, by the triangle inequality, every block whose ball is farther away; only
the others are read and searched, so no vector is copied for queries that can't reach it.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetlake.functions import fixed
from sheetlake.operators.topn import first_n
from sheetlake.operators.vectors import _Nearest, usual_dimension, vector_table
from sheetlake.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors of a block, at most about twice that many; and the most pivots, which go to every task.
BLOCK_ROWS = 1024
MAX_PIVOTS = 2048
#: Headers, and queries, that meet in one task.
HEADERS = 8192
QUERIES = 2048


def _matrix(column: pa.ChunkedArray, dimension: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    rough = (left**2).sum(axis=1)[:, None] + (right**2).sum(axis=1)[None, :] - 2 * left @ right.T
    return np.maximum(rough, 0.0)


def pivots_of(usable: DataFrame, n: int) -> list[list[float]]:
    """Up to ``MAX_PIVOTS`` vectors, about one per block, by a hash of their ids."""
    wanted = min(MAX_PIVOTS, max(1, math.ceil(n / BLOCK_ROWS)))
    return [x.embedding for x in usable.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()]


def save_blocks(vectors: DataFrame, path: str, dimension: int | None = None) -> None:
    """Write ``vectors(id, embedding)`` as blocks.  Vectors of another length or with holes are left out, as ``unsearchable`` lists."""
    dimension = dimension or usual_dimension(vectors) or 1
    usable = vector_table(vectors, dimension)
    n = usable.count()
    kind = dict(vectors.dtypes)["id"]
    pivots = usable.sparkSession.sparkContext.broadcast(np.array(pivots_of(usable, n), np.float64).reshape(-1, dimension))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = _squares(_matrix(pa.chunked_array([batch.column(1)]), dimension), pivots.value).argmin(axis=1)
                yield batch.append_column("pivot", pa.array(near.astype(np.int32)))

    def pack(block: pa.Table) -> pa.Table:
        block = block.sort_by("id")
        matrix = _matrix(block.column("embedding"), dimension)
        centre = matrix.mean(axis=0)
        radius = float(np.sqrt(((matrix - centre) ** 2).sum(axis=1)).max())
        return pa.table(
            {
                "block": block.column("block")[:1],
                "n": pa.array([len(matrix)], pa.int32()),
                "centre": pa.array([centre.tolist()], pa.list_(pa.float64())),
                "radius": pa.array([radius]),
                "ids": pa.array([block.column("id").to_pylist()], pa.list_(block.schema.field("id").type)),
                "data": pa.array([matrix.astype("<f4").tobytes()], pa.binary()),
            }
        )

    dealt = written(usable.mapInArrow(deal, f"id {kind}, embedding array<float>, pivot int"), "dealt")
    # A pivot that very many vectors are nearest to has as many parts as it needs.
    sizes = dealt.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    blocks = dealt.join(F.broadcast(sizes), "pivot").select(
        "id", "embedding", (F.col("pivot").cast("long") * (1 << 32) + part).alias("block")
    )
    packed = blocks.groupBy("block").applyInArrow(
        pack, f"block long, n int, centre array<double>, radius double, ids array<{kind}>, data binary"
    )
    packed.write.mode("overwrite").parquet(path)


def _every(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _parts(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))


def _meet(headers: DataFrame, queries: DataFrame, n_headers: int, n_queries: int, work, schema: str) -> DataFrame:
    """Bounded groups of headers with bounded groups of queries."""
    left = headers.withColumn("v", F.pmod(F.xxhash64("block"), F.lit(n_headers)).cast("int")).withColumn("q", _every(n_queries))
    right = queries.withColumn("q", F.pmod(F.xxhash64("query_id"), F.lit(n_queries)).cast("int")).withColumn("v", _every(n_headers))
    return left.groupBy("v", "q").cogroup(right.groupBy("v", "q")).applyInArrow(work, schema)


def _search(store: DataFrame, asked: DataFrame, pairs: DataFrame, k: int, dimension: int, n_queries: int, schema: str) -> DataFrame:
    """The k nearest per query and block of ``pairs(query_id, block)``."""
    part = F.pmod(F.xxhash64("query_id"), F.lit(n_queries)).cast("int").alias("q")
    wanted = pairs.join(asked, "query_id").select("query_id", "embedding", "block", part)
    needed = wanted.select(F.col("block").alias("block_of"), F.col("q").alias("q_of")).distinct()
    read = needed.join(store.select(F.col("block").alias("block_of"), "ids", "data"), "block_of")

    def nearest(blocks: pa.Table, some: pa.Table) -> pa.Table:
        names, kind = some.column("query_id").combine_chunks(), blocks.schema.field("ids").type.value_type
        search = _Nearest(_matrix(some.column("embedding"), dimension), k)
        for ids, data in zip(blocks.column("ids").to_pylist(), blocks.column("data").to_pylist()):
            search.add(np.array(ids), np.frombuffer(data, "<f4").astype(np.float64).reshape(-1, dimension))
        q, ids, distances = search.rows()
        return pa.table(
            {"query_id": names.take(pa.array(q, pa.int64())), "id": pa.array(ids.tolist(), kind), "distance": pa.array(distances, pa.float64())}
        )

    return read.groupBy("block_of", "q_of").cogroup(wanted.groupBy("block", "q")).applyInArrow(nearest, schema)


def near_blocks(headers: DataFrame, asked: DataFrame, k: int, dimension: int, n_headers: int, n_queries: int, kind: str) -> DataFrame:
    """(query_id, block): for every query the blocks of the nearest centres that hold k vectors together."""

    def centres(blocks: pa.Table, some: pa.Table) -> pa.Table:
        away = _squares(_matrix(some.column("embedding"), dimension), _matrix(blocks.column("centre"), dimension))
        order = np.argsort(away, axis=1, kind="stable")[:, :k]
        q = np.repeat(np.arange(len(away)), order.shape[1])
        return pa.table(
            {
                "query_id": some.column("query_id").take(pa.array(q)),
                "block": blocks.column("block").take(pa.array(order.ravel())),
                "n": blocks.column("n").take(pa.array(order.ravel())),
                "away": pa.array(away[q, order.ravel()]),
            }
        )

    found = _meet(headers, asked, n_headers, n_queries, centres, f"query_id {kind}, block long, n int, away double")
    first = first_n(found, ["query_id"], [F.asc("away"), F.asc("block")], k)
    held = F.sum("n").over(Window.partitionBy("query_id").orderBy("rank"))
    return first.withColumn("held", held).where(F.col("held") - F.col("n") < k).select("query_id", "block")


def reachable_blocks(headers: DataFrame, limits: DataFrame, dimension: int, n_headers: int, n_queries: int, kind: str) -> DataFrame:
    """(query_id, block): blocks whose ball comes within ``limit`` (squared) of the query ``limits(query_id, embedding, limit)``."""

    def balls(blocks: pa.Table, some: pa.Table) -> pa.Table:
        away = np.sqrt(_squares(_matrix(some.column("embedding"), dimension), _matrix(blocks.column("centre"), dimension)))
        reach = np.sqrt(some.column("limit").to_numpy())
        scale = 1 + away + reach[:, None]
        q, v = np.nonzero(away - blocks.column("radius").to_numpy()[None, :] <= reach[:, None] + 1e-6 * scale)
        return pa.table({"query_id": some.column("query_id").take(pa.array(q)), "block": blocks.column("block").take(pa.array(v))})

    return _meet(headers, limits, n_headers, n_queries, balls, f"query_id {kind}, block long")


def knn_l2_stored(store: DataFrame, queries: DataFrame, k: int = fixed.TOP_K) -> DataFrame:
    """The k nearest stored vectors of every query ``(query_id, embedding)``, nearest first; ties go to the lower id.

    ``store`` is what ``save_blocks`` wrote.  Distances are squared.  Queries of another length or with holes
    find nothing.
    """
    kind, id_kind = dict(queries.dtypes)["query_id"], dict(store.dtypes)["ids"][len("array<") : -1]
    schema = f"query_id {kind}, id {id_kind}, distance double"
    size = store.agg(F.count("*").alias("blocks"), F.max(F.size("centre")).alias("dimension")).head()
    if not size.blocks:
        return queries.sparkSession.createDataFrame([], f"query_id {kind}, rank int, id {id_kind}, distance double")
    asked = vector_table(queries.withColumnRenamed("query_id", "id"), size.dimension).withColumnRenamed("id", "query_id")
    asked = written(asked, "asked")
    n_headers, n_queries = _parts(size.blocks, HEADERS), _parts(asked.count(), QUERIES)
    headers = store.select("block", "n", "centre", "radius")
    near = near_blocks(headers, asked, k, size.dimension, n_headers, n_queries, kind)
    order = [F.asc("distance"), F.asc("id")]
    first = first_n(_search(store, asked, near, k, size.dimension, n_queries, schema), ["query_id"], order, k)
    # With fewer than k vectors in all there is nothing to rule out.
    limits = first.groupBy("query_id").agg(
        F.when(F.count("*") == k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("limit")
    )
    limited = written(asked.join(limits, "query_id"), "limits")
    pairs = written(reachable_blocks(headers, limited, size.dimension, n_headers, n_queries, kind), "pairs")
    found = _search(store, asked, pairs, k, size.dimension, n_queries, schema)
    return first_n(found, ["query_id"], order, k).select("query_id", "rank", "id", "distance")
