"""The trie of conversation prefixes, with totals per subtree.

Conversations are rebuilt with a shared beginning; each distinct sequence of first
turns is a node.  A prefix is named by the sums of four parts of the SHA-256 digests of its (place, role,
text) triples, so names come from running sums in bounded slices and a parent's name from a subtraction;
no conversation is held in one task.  Totals over subtrees come from centroid
decomposition of the parent edges (``centroids``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetlake.llm.centroids import LIMIT, lookup, subtree_sums
from sheetlake.llm.labelled import crc_mod
from sheetlake.llm.scratch import Scratch
from sheetlake.llm.ship import ship
from sheetlake.operators.ordered import running_total
from sheetlake.session import written

SHARED = 100
HEADS = 6
SLICE = 1 << 12
SEGMENT_IDS = 4096
PARTS = ("h0", "h1", "h2", "h3")
NO_ENDS = hashlib.sha256(b"").hexdigest()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, role, text, n_turns): the turns of every rebuilt conversation, and one row of depth 0 each.

    Turns are in order of ``turn`` (null first), then role and text.
    """
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    placed = written(
        running_total(turns, ["conv_id"], ["turn", "role", "text"], F.lit(1), "place").select("conv_id", "place", "role", "text"),
        "turns",
    )
    counts = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    heads = crc_mod(F.col("conv_id"), HEADS)
    own = counts.select("conv_id", "n", heads.alias("h"), (F.col("conv_id") - F.col("conv_id") % SHARED).alias("base"))
    first = placed.where(F.col("place") < HEADS)
    lengths = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plans = written(
        own.join(lengths, "base", "left").select(
            "conv_id", "base", "h", F.least(F.col("h"), F.coalesce("n_base", F.lit(0))).alias("k"), "n"
        ),
        "plans",
    ).withColumn("n_turns", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    shared = first.withColumnRenamed("conv_id", "base").join(plans, "base").where("place <= h")
    # A conversation's plan meets its turns in slices of places, however many it has.
    slices = plans.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / SLICE))))
    rest = placed.withColumn("_slice", F.floor(F.col("place") / SLICE)).join(slices, ["conv_id", "_slice"]).where("place > h")
    text = ("role", "text", "n_turns")
    return (
        shared.select("conv_id", F.col("place").alias("depth"), *text)
        .unionByName(rest.select("conv_id", (F.col("place") - F.col("h") + F.col("k")).alias("depth"), *text))
        .unionByName(
            plans.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("role"), F.lit("").alias("text"), "n_turns")
        )
    )


def _parts() -> list[Column]:
    """Four numbers below 2**32 for a turn at its place; 0 for depth 0."""
    said = F.concat(
        F.col("depth").cast("string"), F.lit(":"), F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")
    )
    digest = F.sha2(said, 256)
    return [
        F.when(F.col("depth") > 0, F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long")).otherwise(0).alias(name)
        for k, name in enumerate(PARTS)
    ]


def _name(depth: Column, sums: list[Column]) -> Column:
    """16 bytes that name a prefix by its depth and sums."""
    return F.unhex(F.substring(F.sha2(F.concat_ws(",", depth.cast("string"), *(x.cast("string") for x in sums)), 256), 1, 32))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, up, top, chars, ends) for rows of ``rebuilt``: each prefix, its parent and the tree it is in."""
    parted = written(
        turns.select(
            "conv_id",
            "depth",
            "n_turns",
            F.length("text").cast("long").alias("chars"),
            *_parts(),
            F.floor(F.col("depth") / SLICE).alias("_slice"),
        ),
        "parts",
    )
    sums = parted.groupBy("conv_id", "_slice").agg(
        *(F.sum(x).alias(x) for x in PARTS), *(F.max(F.when(F.col("depth") == 1, F.col(x))).alias(f"_{x}") for x in PARTS)
    )
    before = Window.partitionBy("conv_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = sums.select(
        "conv_id",
        "_slice",
        *(F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"_c{x}") for x in PARTS),
        *(F.max(f"_{x}").over(whole).alias(f"_f{x}") for x in PARTS),
    )
    inside = Window.partitionBy("conv_id", "_slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = parted.select("*", *(F.sum(x).over(inside).alias(f"_s{x}") for x in PARTS)).join(carried, ["conv_id", "_slice"])
    total = [F.col(f"_s{x}") + F.col(f"_c{x}") for x in PARTS]
    depth = F.col("depth")
    return summed.select(
        "conv_id",
        "depth",
        _name(depth, total).alias("node"),
        F.when(depth > 0, _name(depth - 1, [t - F.col(x) for t, x in zip(total, PARTS)])).alias("up"),
        F.when(depth > 0, _name(F.lit(1), [F.col(f"_f{x}") for x in PARTS])).alias("top"),
        "chars",
        (depth == F.col("n_turns")).alias("ends"),
    )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by node and conversation, decimal ids joined by commas, up to ``SEGMENT_IDS`` of one node in a row."""
    node, ids = None, []
    nodes, firsts, joined = [], [], []

    def close() -> None:
        if ids:
            nodes.append(node)
            firsts.append(ids[0])
            joined.append(",".join(map(str, ids)))

    for batch in batches:
        for own, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if own != node or len(ids) == SEGMENT_IDS:
                close()
                node, ids = own, []
            ids.append(conv_id)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(firsts, pa.int64()), pa.array(joined, pa.string())], ["node", "first", "ids"]
        )
        nodes, firsts, joined = [], [], []
    close()
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.binary()), pa.array(firsts, pa.int64()), pa.array(joined, pa.string())], ["node", "first", "ids"]
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined segments of each node; only the state of the digest is held."""
    node, state = None, None
    for batch in batches:
        nodes, found = [], []
        for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if own != node:
                if state is not None:
                    nodes.append(node)
                    found.append(state.hexdigest())
                node, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(found, pa.string())], ["node", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])


def end_digests(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256) of ``rows(node, conv_id)``, each conversation at the node where it ends."""
    segments = (
        rows.select("node", "conv_id")
        .repartitionByRange("node", "conv_id")
        .sortWithinPartitions("node", "conv_id")
        .mapInArrow(_segments, "node binary, first long, ids string")
    )
    return segments.repartition("node").sortWithinPartitions("node", "first").mapInArrow(
        _digests, "node binary, ends_sha256 string"
    )


def prefix_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie of ``conversations(conv_id, turn, role, text)``.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  Null roles and
    texts are empty; a null turn comes first; equal turns go by role and text, and rows that repeat
    are turns of their own.  Rows without ``conv_id`` belong to no conversation and are left out.  Other columns
    are ignored; an empty table gives no rows, not even a root.
    """
    ship(conversations.sparkSession)
    spark = conversations.sparkSession
    with Scratch(spark) as scratch:
        rows = scratch.written(prefixes(rebuilt(conversations)), "prefixes")
        nodes = scratch.written(
            rows.groupBy("node").agg(
                F.min("conv_id").alias("conv_id"),
                F.min("depth").alias("depth"),
                F.count(F.lit(1)).alias("n_convs"),
                F.max("chars").alias("chars"),
                F.min("up").alias("up"),
                F.min("top").alias("top"),
            ),
            "nodes",
        )
        children = nodes.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
        parents = nodes.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
        tops = nodes.where("depth = 1").select(F.col("node").alias("top"), F.col("conv_id").alias("comp"))
        full = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        full = scratch.written(lookup(lookup(full, "up", parents), "top", tops), "full")
        own = full.where("depth > 0").select(
            "node",
            F.when(F.col("depth") > 1, F.col("up")).alias("up"),
            "depth",
            "comp",
            (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        )
        sums = subtree_sums(own, ["n_leaves", "saved_tokens"], limit)
        below = sums.join(full.where("depth = 1").select("node"), "node", "left_semi")
        # Named like every prefix of depth 0; without conversations it meets no node.
        root = below.agg(
            _name(F.lit(0), [F.lit(0)] * len(PARTS)).alias("node"),
            F.greatest(F.coalesce(F.sum("n_leaves"), F.lit(0)), F.lit(1)).alias("n_leaves"),
            F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"),
        )
        ends = end_digests(rows.where("ends"))
        return written(
            full.join(sums.unionByName(root), "node")
            .join(ends, "node", "left")
            .select(
                "conv_id",
                "depth",
                "parent_conv_id",
                "n_convs",
                F.col("n_children").cast("long").alias("n_children"),
                "n_leaves",
                "saved_tokens",
                F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
            ),
            "trie",
        )
