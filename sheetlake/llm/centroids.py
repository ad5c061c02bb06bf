"""Subtree totals of a forest by centroid decomposition.

A component is a connected part of the forest, at first a whole tree.  Its nodes
whose own part holds more than half of it form a path from its top; the deepest of them
is the centroid.  The total of what hangs at the centroid is added to the centroid and to
every node on the path to the top, the centroid leaves, and what remains above it and below each of its children
are components of at most half the size.  So each node is added to once per
level, and there are no more levels than the logarithm of the largest tree, however
deep or wide it is.

Components of up to ``LIMIT`` nodes are decomposed inside tasks, many at a time.  Larger ones are split
by joins until they are that small; their order and sizes come from doubling the parent pointers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sheetlake.llm.chosenpath import by_key, rows_by_key
from sheetlake.llm.scratch import Scratch
from sheetlake.llm.ship import ship
from sheetlake.operators.ordered import running_total
from sheetlake.session import written

LIMIT = 1 << 16
SALTS = 32
SLICE = 1 << 14


def lookup(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """Left join with ``table``, whose column ``key`` is unique; a key that a third of the rows share meets in parts."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    cells = salted.where(F.col(key).isNotNull()).groupBy(key, "_salt").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    return salted.join(cells.join(table, key), [key, "_salt"], "left").drop("_salt")


def preorder(parent: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of every node in a preorder of the forest, and the size of its subtree; tops have the parent -1."""
    n = len(parent)
    size, place = np.ones(n, np.int64), np.zeros(n, np.int64)
    by_depth = np.argsort(depth, kind="stable")
    levels = np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1) if n else []
    for level in levels[:0:-1]:
        np.add.at(size, parent[level], size[level])
    siblings = np.lexsort((np.arange(n), parent))
    before = np.cumsum(size[siblings]) - size[siblings]
    first = np.flatnonzero(np.diff(parent[siblings], prepend=-2))
    before -= np.repeat(before[first], np.diff(np.append(first, n)))
    place[siblings] = before
    for level in levels[1:]:
        place[level] += place[parent[level]] + 1
    return place, size


def totals(comp: np.ndarray, pre: np.ndarray, size: np.ndarray, parent: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For every node the sums of the rows of ``weights`` over its part of the component it is in.

    ``pre`` orders the nodes of a component, ``size`` is the width of the range
    that a whole subtree takes in it, ``parent`` is the parent's place in that order.  A component
    may lack whole subtrees of its tree.
    """
    n = len(pre)
    order = np.lexsort((pre, comp))
    comp, pre, size, parent = comp[order], pre[order], size[order], parent[order]
    own = weights[order]
    sums = np.zeros_like(own)
    comp = np.cumsum(np.diff(comp, prepend=comp[:1] - 1) != 0) - 1 if n else comp
    # Nodes of a component follow each other, and a node's part of it follows the node.
    inside = _parts(comp, pre, size)
    live = np.arange(n)
    while len(live):
        label, at = np.unique(comp[live], return_inverse=True)
        number = np.bincount(at)
        heavy = 2 * inside[live] > number[at]
        centroid = np.zeros(len(label), np.int64)
        np.maximum.at(centroid, at[heavy], live[heavy])
        c = centroid[at]
        below = (live >= c) & (pre[live] < pre[c] + size[c])
        part = np.zeros((len(label), own.shape[1]), own.dtype)
        np.add.at(part, at[below], own[live[below]])
        sums[live[heavy]] += part[at[heavy]]
        above = heavy & (live != c)
        inside[live[above]] -= inside[c[above]]
        # What is below a centroid takes its label from the last of the centroid's children at or before it.
        child = below & (parent[live] == pre[c]) & (live != c)
        mark = np.maximum.accumulate(at * n + np.where(child, live, 0)) - at * n
        fresh = below & (live != c)
        comp[live[fresh]] = n + mark[fresh]
        live = live[live != c]
        live = live[np.lexsort((live, comp[live]))]
    out = np.zeros_like(sums)
    out[order] = sums
    return out


def _parts(comp: np.ndarray, pre: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many nodes of its component each node has in its subtree, itself included; nodes sorted by comp and pre."""
    if not len(pre):
        return np.zeros(0, np.int64)
    span = int(pre.max() + size.max()) + 2
    key = comp * span + pre
    return np.searchsorted(key, comp * span + pre + size) - np.arange(len(pre))


def _forests(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Whole components, together up to about ``limit`` rows."""
    held, size = [], 0
    for component in rows_by_key(batches, "comp"):
        held.append(component)
        size += component.num_rows
        if size >= limit:
            yield pa.concat_tables(held)
            held, size = [], 0
    if held:
        yield pa.concat_tables(held)


def _weights(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    return np.stack([table.column(x).to_numpy() for x in names], axis=1).astype(np.int64)


def _yielded(table: pa.Table, sums: np.ndarray, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    columns = [table.column("node"), *(pa.chunked_array([pa.array(sums[:, k])]) for k in range(len(names)))]
    yield from pa.table(columns, names=["node", *names]).combine_chunks().to_batches()


def _whole_trees(names: Sequence[str], limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for forest in _forests(batches, limit):
            nodes = forest.column("node").to_pylist()
            place = {x: k for k, x in enumerate(nodes)}
            above = np.array([place.get(x, -1) for x in forest.column("up").to_pylist()], np.int64)
            pre, size = preorder(above, forest.column("depth").to_numpy())
            comp = np.unique(forest.column("comp").to_numpy(), return_inverse=True)[1]
            # Tops have no parent; the places of the trees of a forest begin anew with each.
            parent = np.where(above < 0, -1, pre[above])
            yield from _yielded(forest, totals(comp, pre, size, parent, _weights(forest, names)), names)

    return work


def _split_parts(names: Sequence[str], limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for forest in _forests(batches, limit):
            comp, pre, size, parent = (forest.column(x).to_numpy() for x in ("comp", "pre", "size", "parent"))
            yield from _yielded(forest, totals(comp, pre, size, parent, _weights(forest, names)), names)

    return work


def subtree_sums(nodes: DataFrame, names: Sequence[str], limit: int = LIMIT) -> DataFrame:
    """(node, *names): the sums over each node's subtree, for ``nodes(node binary, up binary, depth, comp long, *names)``.

    ``comp`` names the tree and ``up`` is the parent, null at the top of a tree.
    """
    spark = nodes.sparkSession
    ship(spark)
    sums = f"node binary, {', '.join(f'{x} long' for x in names)}"
    sizes = nodes.groupBy("comp").agg(F.count(F.lit(1)).alias("n"))
    with Scratch(spark) as scratch:
        wide = scratch.written(sizes.where(F.col("n") > limit), "wide")
        if wide.isEmpty():
            return written(by_key(nodes, "comp", _whole_trees(names, limit), sums), "sums")
        wide = scratch.written(
            running_total(wide, [], ["comp"], F.col("n")).select("comp", "n", (F.col("total") - F.col("n")).alias("base")), "bases"
        )
        marked = scratch.written(lookup(nodes, "comp", wide), "trees")
        small = by_key(marked.where("n is null").drop("n", "base"), "comp", _whole_trees(names, limit), sums)
        placed = scratch.written(placed_trees(marked.where("n is not null"), names, scratch), "placed")
        added, rest = split(placed, names, limit, scratch)
        parts = by_key(rest, "comp", _split_parts(names, limit), sums)
        large = added.unionByName(parts).groupBy("node").agg(*(F.sum(x).alias(x) for x in names))
        return written(small.unionByName(large), "sums")


def placed_trees(nodes: DataFrame, names: Sequence[str], scratch: Scratch) -> DataFrame:
    """Preorder place, subtree size and parent's place of the nodes of large trees, by doubling the parent pointers.

    Places begin at the tree's ``base``, so they are distinct over all trees; a component is
    named by the place of its top.
    """
    state = scratch.written(nodes.select("node", F.col("up").alias("to"), F.lit(1).cast("long").alias("size")), "jumps")
    while not state.where("to is not null").isEmpty():
        sums = state.where("to is not null").groupBy("to").agg(F.sum("size").alias("_more"))
        grown = state.join(sums.withColumnRenamed("to", "node"), "node", "left")
        further = state.select(F.col("node").alias("to"), F.col("to").alias("_next"))
        state = scratch.written(
            lookup(grown.withColumn("size", F.col("size") + F.coalesce("_more", F.lit(0))).drop("_more"), "to", further).select(
                "node", F.col("_next").alias("to"), "size"
            ),
            "jumps",
        )
    sized = scratch.written(nodes.join(state.select("node", "size"), "node"), "sized")
    below = sized.where("up is not null").select("node", "up", "size")
    # A child comes behind its parent and the subtrees of earlier children.
    steps = running_total(below, ["up"], ["node"], F.col("size")).select(
        "node", F.col("up").alias("to"), (F.col("total") - F.col("size") + 1).alias("step")
    )
    tops = sized.where("up is null").select("node", F.col("up").alias("to"), F.col("base").alias("step"))
    state = scratch.written(steps.unionByName(tops), "steps")
    while not state.where("to is not null").isEmpty():
        further = state.select(F.col("node").alias("to"), F.col("to").alias("_next"), F.col("step").alias("_step"))
        state = scratch.written(
            lookup(state, "to", further).select(
                "node", F.col("_next").alias("to"), (F.col("step") + F.coalesce("_step", F.lit(0))).alias("step")
            ),
            "steps",
        )
    places = scratch.written(state.select("node", F.col("step").alias("pre")), "places")
    above = places.select(F.col("node").alias("up"), F.col("pre").alias("parent"))
    return lookup(sized.join(places, "node"), "up", above).select(
        "node", F.col("base").alias("comp"), "pre", "size", F.coalesce("parent", F.lit(-1)).alias("parent"), *names
    )


def split(placed: DataFrame, names: Sequence[str], limit: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(node, *names) that was added to nodes of large components, and the components that are left, none over ``limit``."""
    rows = placed.withColumn("inside", F.col("size"))
    added, done = [], []
    while True:
        counts = rows.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
        marked = scratch.written(lookup(rows, "comp", counts), "marked")
        done.append(marked.where("n is null").drop("n"))
        large = marked.where("n is not null")
        if large.isEmpty():
            break
        heavy = 2 * F.col("inside") > F.col("n")
        centroids = scratch.written(
            large.where(heavy)
            .groupBy("comp")
            .agg(F.max(F.struct("pre", "size", "inside")).alias("c"))
            .select("comp", F.col("c.pre").alias("c"), (F.col("c.pre") + F.col("c.size")).alias("c_end"), F.col("c.inside").alias("c_inside")),
            "centroids",
        )
        seen = scratch.written(lookup(large.withColumn("heavy", heavy).drop("n"), "comp", centroids), "seen")
        below = (F.col("pre") >= F.col("c")) & (F.col("pre") < F.col("c_end"))
        parts = seen.where(below).groupBy("comp").agg(*(F.sum(x).alias(f"_{x}") for x in names))
        added.append(lookup(seen.where("heavy").select("node", "comp"), "comp", parts).select("node", *(F.col(f"_{x}").alias(x) for x in names)))
        rows = scratch.written(_relabelled(seen, scratch).select(*rows.columns), "rest")
    together = added[0]
    for more in added[1:]:
        together = together.unionByName(more)
    left = done[0]
    for more in done[1:]:
        left = left.unionByName(more)
    return together, left.select("node", "comp", "pre", "size", "parent", *names)


def _relabelled(seen: DataFrame, scratch: Scratch) -> DataFrame:
    """The components that remain without their centroids: above each, and below each of its children.

    What is below takes its label from the last child of the centroid at or before it in
    preorder: a running maximum, taken in slices of places and carried from slice to slice.
    """
    below = (F.col("pre") > F.col("c")) & (F.col("pre") < F.col("c_end"))
    marked = (
        seen.where(F.col("pre") != F.col("c"))
        .withColumn("_below", below)
        .withColumn("_mark", F.when(below & (F.col("parent") == F.col("c")), F.col("pre")))
        .withColumn("_slice", F.floor(F.col("pre") / SLICE))
    )
    upto = Window.partitionBy("comp", "_slice").orderBy("pre").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("comp").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    tops = marked.groupBy("comp", "_slice").agg(F.max("_mark").alias("_top"))
    carried = tops.select("comp", "_slice", F.max("_top").over(before).alias("_carried"))
    labelled = marked.withColumn("_mark", F.max("_mark").over(upto)).join(carried, ["comp", "_slice"])
    child = F.greatest("_mark", "_carried")
    path = F.col("heavy") & ~F.col("_below")
    return labelled.withColumn("inside", F.col("inside") - F.when(path, F.col("c_inside")).otherwise(0)).withColumn(
        "comp", F.when(F.col("_below"), child).otherwise(F.col("comp"))
    )
