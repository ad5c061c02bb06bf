"""Near duplicates: an exact threshold on word-shingle sets, found by chosen-path trees.

Texts with the same set of shingles form one class; one of them stands for it.
In each of ``TREES`` independent trees the representatives are split by the
smallest value of one minwise function; a node that is still too large sends its
members on to ``BRANCHES`` children, along minwise functions chosen by the
node.  A pair at the threshold follows its parts into a common small node of one
tree with probability 0.75, of any of ten trees with 1 - 1e-6.
Small nodes are compared exhaustively: byte sketches first (a pair at
the threshold is passed over with probability below 1e-6), then the full sets.
A node that will not shrink is compared exhaustively as well, in pairs of blocks.
What a node finds alike is a crowd; crowds that share members are put together where their full sets are
then compared in fewer pairs, as the trees find the same large group of near copies again and again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from sheetlake.llm import alike
from sheetlake.llm.keyfilter import key_filter, maybe_in
from sheetlake.llm.links import components
from sheetlake.llm.scratch import Scratch
from sheetlake.llm.shingles import SKETCH, set_key, shingle_sets, sketch
from sheetlake.llm.ship import ship
from sheetlake.llm.words import mix
from sheetlake.operators.sizes import is_small
from sheetlake.session import written

TREES = 10
BRANCHES = 2
LEVELS = 6
NODE_ROWS = 4096
#: A node that so many steps in a row have left with more than this share of its rows is compared as it is.
SLOW_STEPS = 3
SHRUNK = 0.7
#: Rows of a block of such a node.
BLOCK_ROWS = 16_384
UNIT_BYTES = 16 << 20
RUN_BYTES = 1 << 20

SIGNED = "doc_id long, body string, n_shingles long, set_key binary, roots array<long>, sketch binary"


def passing(percent: int) -> int:
    """Equal sketch bytes that a pair at the threshold has but for one in 1e6, by the normal bound."""
    p = percent / 100
    return int(np.floor(SKETCH * p - 4.85 * np.sqrt(SKETCH * p * (1 - p))))


def rows_by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key in turn, from batches in which equal keys follow each other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(column[1:] != column[:-1]) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for first, last in zip(bounds, bounds[1:]):
            part = batch.slice(first, last - first)
            if held and held[0].column(batch.schema.get_field_index(key))[0].as_py() != column[first]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def runs_by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The rows of many whole keys at a time and where each key begins, and the end, as ``rows_by_key`` takes one."""
    held: list[pa.RecordBatch] = []
    last = None

    def run() -> tuple[pa.Table, np.ndarray]:
        rows = pa.Table.from_batches(held)
        keys = rows.column(key).to_numpy()
        return rows, np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        if held and sum(x.nbytes for x in held) >= RUN_BYTES and keys[-1] != last:
            cut = int(np.flatnonzero(np.concatenate([[last], keys[:-1]]) != keys)[-1])
            if cut:
                held.append(batch.slice(0, cut))
            yield run()
            held, batch = [], batch.slice(cut)
        held.append(batch)
        last = keys[-1]
    if held:
        yield run()


def by_key(frame: DataFrame, key: str, work: Callable, schema: str) -> DataFrame:
    """Apply a batch function to rows laid out so that equal keys follow each other in one task."""
    return frame.repartition(key).sortWithinPartitions(key).mapInArrow(work, schema)


def _signer(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, roots, sketches = [], [], [], []
            for members in shingle_sets(batch.column(1).to_pylist(), size):
                counts.append(len(members))
                if not len(members):
                    keys.append(None)
                    roots.append(None)
                    sketches.append(None)
                    continue
                least = sketch(members)
                keys.append(set_key(members))
                roots.append(mix(least[:TREES] + np.arange(TREES, dtype=np.uint64)).view(np.int64))
                sketches.append((least >> np.uint64(40)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(counts, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(roots, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "body", "n_shingles", "set_key", "roots", "sketch"],
            )

    return sign


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    """A column of sketches as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)


def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's children along minwise functions chosen by its node; further columns go on unchanged."""
    for batch in batches:
        node = batch.column(0).to_numpy().view(np.uint64)
        marks = _bytes(batch.column(2))
        for k in range(BRANCHES):
            chosen = mix(node + np.uint64(k + 1))
            place = (chosen % np.uint64(SKETCH)).astype(np.int64)
            child = mix(chosen ^ marks[np.arange(len(place)), place].astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *batch.columns[1:]], batch.schema.names)


def _compare_sketches(least: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in runs_by_key(batches, "unit"):
            reps = rows.column("rep").to_numpy()
            label = alike.groups(_bytes(rows.column("sketch")), bounds, least)
            keep = np.bincount(label, minlength=len(label))[label] > 1
            if not keep.any():
                continue
            names, heads = np.zeros(len(reps), np.uint64), reps.copy()
            np.add.at(names, label, mix(reps.view(np.uint64)))
            np.minimum.at(heads, label, reps)
            kept = label[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix(names[kept]).view(np.int64)), pa.array(heads[kept]), pa.array(reps[keep])],
                ["crowd", "head", "rep"],
            )

    return work


def _compare_sets(least: int, percent: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in runs_by_key(batches, "unit"):
            reps, marks = rows.column("rep").to_numpy(), _bytes(rows.column("sketch"))
            members, pairs = rows.column("members"), []
            for first, last in zip(bounds.tolist(), bounds[1:].tolist()):
                found = alike.links(marks[first:last], members.slice(first, last - first).to_pylist(), least, percent)
                pairs += [(first + a, first + b) for a, b in found]
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reps[[a for a, _ in pairs]]), pa.array(reps[[b for _, b in pairs]])], ["a", "b"]
                )

    return work


def _units(rows: DataFrame, key: str, blocks: str) -> DataFrame:
    """Rows dealt to pairs of different blocks; a key with one block is one unit."""
    return (
        rows.withColumn("_blk", F.pmod(F.xxhash64("rep"), F.col(blocks)))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
        .where(f"_blk <> _other or {blocks} = 1")
        .withColumn("unit", F.xxhash64(key, F.least("_blk", "_other"), F.greatest("_blk", "_other")))
        .drop("_blk", "_other", key, blocks)
    )


def crowds(reps: DataFrame, percent: int) -> DataFrame:
    """(crowd, rep): representatives connected by alike sketches in a common small node, or in several."""
    least = passing(percent)
    start = {"slow": F.lit(0).cast("long"), "parent": F.lit(None).cast("long")}
    rows = reps.select(F.explode("roots").alias("node"), "rep", "sketch").withColumns(start)
    found = None
    with Scratch(reps.sparkSession) as scratch:
        for level in range(LEVELS + 1):
            rows = scratch.written(rows, "paths") if level else rows
            counts = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            slow = F.when(F.col("n") > SHRUNK * F.col("parent"), F.col("slow") + 1).otherwise(0)
            live = scratch.written(rows.join(counts, "node").withColumn("slow", slow).drop("parent"), "nodes")
            last = level == LEVELS
            whole = F.lit(last) | (F.col("n") <= NODE_ROWS) | (F.col("slow") >= SLOW_STEPS)
            blocks = F.when(F.col("n") <= NODE_ROWS, 1).otherwise(F.ceil(F.col("n") / BLOCK_ROWS)).cast("long")
            units = _units(live.where(whole).withColumn("_blocks", blocks).drop("n", "slow"), "node", "_blocks")
            some = by_key(units, "unit", _compare_sketches(least), "crowd long, head long, rep long")
            found = some if found is None else found.unionByName(some)
            rows = live.where(~whole).select("node", "rep", "sketch", "slow", F.col("n").alias("parent"))
            if last or rows.isEmpty():
                break
            rows = rows.mapInArrow(branch, "node long, rep long, sketch binary, slow long, parent long")
        return written(_together(scratch.written(found.dropDuplicates(["crowd", "rep"]), "found")), "crowds")


def _together(found: DataFrame) -> DataFrame:
    """(crowd, rep) of ``found(crowd, head, rep)``: crowds that share members are one crowd where that makes fewer pairs."""
    group = components(found.select(F.col("head").alias("a"), F.col("rep").alias("b")))
    rows = found.join(group.withColumnRenamed("id", "rep"), "rep").select("crowd", "rep", "component")
    apart = rows.groupBy("component", "crowd").agg(F.count(F.lit(1)).cast("double").alias("n"))
    apart = apart.groupBy("component").agg(F.sum(F.col("n") * F.col("n")).alias("apart"))
    whole = group.groupBy("component").agg(F.count(F.lit(1)).cast("double").alias("n"))
    better = whole.join(apart, "component").where("n * n > apart").select("component", F.lit(True).alias("apart"))
    better = written(better, "apart")
    # Few or none, as a rule; a large component's rows stay where they are.
    marked = rows.join(F.broadcast(better) if is_small(better) else better, "component", "left")
    return marked.select(F.when(F.col("apart"), F.col("crowd")).otherwise(F.col("component")).alias("crowd"), "rep").distinct()


def _set_rows(size: int, wanted: Broadcast) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(maybe_in(wanted.value, batch.column(0).to_numpy())))
            sets = list(shingle_sets(batch.column(1).to_pylist(), size))
            keys = pa.array([set_key(x) if len(x) else None for x in sets], pa.binary())
            members = pa.array([x.tobytes() for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), keys, members], ["doc_id", "set_key", "members"])

    return work


def links(docs: DataFrame, reps: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): confirmed links between representatives, a spanning forest of each compared unit.

    Texts are read again for the full sets, and only those that a filter of
    fixed size lets through leave their place.
    """
    found = crowds(reps.select("rep", "roots", "sketch"), percent)
    near = found.join(reps.select("rep", "doc_id", "set_key", "sketch"), "rep")
    wanted = docs.sparkSession.sparkContext.broadcast(key_filter(near.select("doc_id")))
    sets = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .where("doc_id is not null")
        .mapInArrow(_set_rows(size, wanted), "doc_id long, set_key binary, members binary")
        .groupBy("doc_id", "set_key")
        .agg(F.first("members").alias("members"))
    )
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.written(near.join(sets, ["doc_id", "set_key"]).drop("doc_id", "set_key"), "sets")
        blocks = rows.groupBy("crowd").agg(
            F.ceil(F.sum(F.octet_length("members") + 200) / UNIT_BYTES).cast("long").alias("_blocks")
        )
        units = _units(rows.join(blocks, "crowd"), "crowd", "_blocks")
        return written(by_key(units, "unit", _compare_sets(passing(percent), percent), "a long, b long"), "links")


def verdicts(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, body, n_shingles, component_id, kept for every row of ``docs``; ``body`` is the SHA-256 of the text.

    What is linked are classes of equal sets, each with a number of its own, so
    different texts of one ``doc_id`` are never taken for each other.
    """
    spark = docs.sparkSession
    ship(spark)
    body = F.sha2(F.col("text"), 256).alias("body")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = written(texts.select("*", body).mapInArrow(_signer(size), SIGNED), "signed")
    able = signed.where("doc_id is not null and set_key is not null")
    # The numbers are written with the classes, so every later reader sees the same ones.
    least = able.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"))
    classes = written(least.withColumn("rep", F.monotonically_increasing_id()), "classes")
    reps = able.select("set_key", "doc_id", "roots", "sketch").join(classes, ["set_key", "doc_id"]).dropDuplicates(["rep"])
    reps = written(reps, "reps")
    labels = components(links(docs, reps, size, percent))
    linked = classes.join(labels.withColumnRenamed("id", "rep"), "rep")
    named = linked.join(linked.groupBy("component").agg(F.min("doc_id").alias("_component")), "component")
    own = F.when(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull(), F.coalesce("_component", "_least"))
    found = classes.select("set_key", F.col("doc_id").alias("_least"), "rep").join(
        written(named.select("rep", "_component"), "named"), "rep", "left"
    )
    rows = signed.drop("roots", "sketch").join(found.drop("rep"), "set_key", "left").withColumn(
        "component_id", F.coalesce(own, F.col("doc_id"))
    )
    return rows.select("doc_id", "body", "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("doc_id")).alias("kept"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs(doc_id, text)``.

    Words are runs of visible bytes of the text with A-Z in lower case.  Sets of
    ``size``-word shingles are linked when 100 * |both| >= percent * |either|;
    a component is what links connect, and its smallest ``doc_id`` is kept.  A text
    that is null, empty or blank has an empty set and is linked with nothing.
    A row without ``doc_id`` is linked with nothing: its component is null and it is
    kept.  Rows of one ``doc_id`` with different texts are documents of their own, each with the component of its text; rows
    that repeat both share one verdict.  An empty table gives no rows; other columns are ignored.
    """
    return verdicts(docs, size, percent).drop("body")


def drop_near_copies(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` of which one per component stays, with all their columns.

    A row goes by the verdict on its own text.  Several texts of the ``doc_id`` that stays, if near copies of each other, all stay.
    """
    gone = verdicts(docs, size, percent).where("not kept").select(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).distinct()
    same = (docs["doc_id"].cast("long") == gone["_id"]) & F.sha2(docs["text"].cast("string"), 256).eqNullSafe(gone["_body"])
    return docs.join(gone, same, "left_anti")
