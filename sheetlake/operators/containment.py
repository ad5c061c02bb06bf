"""Which names contain which of very many keywords, by an equality join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetlake.operators.sizes import is_small
from sheetlake.session import written

#: Characters of the runs that names and keywords meet by; shorter keywords meet by runs of their own length.
GRAM = 6
#: Characters of a name whose runs are looked at together.
SLICE = 1 << 16
#: Names whose runs are handed on together.
ROWS = 100


def _with_runs(names: DataFrame, size: int, only: frozenset[str] | None = None) -> DataFrame:
    """Names with ``runs``: all their distinct runs of up to ``size`` characters, or those of a small set."""
    part, rows = SLICE, ROWS
    # A byte that is no text is part of no run that a keyword has.
    errors = "replace" if only is None else "surrogateescape"

    def runs_of(name):
        kept = set()
        for start in range(0, len(name), part):
            text = name[start : start + part + size - 1]
            runs = {text[i : i + size] for i in range(len(text))}
            for k in range(size, 0, -1):
                runs = {x[:k] for x in runs} if k < size else runs
                kept |= runs if only is None else runs & only
        return list(kept)

    def runs_in(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in (whole.slice(at, rows) for at in range(0, whole.num_rows, rows)):
                texts = batch.column("name").cast(pa.binary()).to_pylist()
                found = pa.array([runs_of(x.decode("utf-8", errors)) for x in texts], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "runs"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in names.dtypes)
    return names.mapInArrow(runs_in, f"{kinds}, runs array<string>")


def _runs_of_keyword(keyword: Column) -> Column:
    """All distinct runs of ``GRAM`` characters; a keyword that has no more is its own run."""
    places = F.sequence(F.lit(1), F.greatest(F.length(keyword) - GRAM + 1, F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.substring(keyword, i, GRAM)))


def containing_names(names: DataFrame, keywords: DataFrame, small: bool | None = None) -> DataFrame:
    """(keyword, name) for every distinct ``names(name)`` that contains a ``keywords(keyword)``, each pair once.

    A keyword meets only the names that have its rarest run of characters, so the work follows that
    run's frequency, not names times keywords; ``contains`` then decides on those longer than it.  Few keywords go to every task and meet
    the names where they lie; for many, runs carry the name's number, not the name.  Null and empty keywords match
    nothing.  ``small`` tells what is known about the keywords; they are counted if nothing is.
    """
    distinct = names.select("name").where(F.col("name").isNotNull()).distinct()
    asked = keywords.select("keyword").where(F.length("keyword") > 0).distinct()
    cut = asked.select("keyword", _runs_of_keyword(F.col("keyword")).alias("runs"))
    wanted = written(cut.select("keyword", F.size("runs").alias("n_runs"), F.explode("runs").alias("gram")), "keyword-runs")
    grams = wanted.select("gram").distinct()
    # Only runs that some keyword has leave the task.
    if is_small(wanted) if small is None else small:
        only = frozenset(x.gram for x in grams.collect())
        runs = written(_with_runs(distinct, GRAM, only), "names").select("name", F.explode("runs").alias("gram"))
        met = runs.join(F.broadcast(_rarest(wanted, runs)), "gram")
    else:
        known = written(distinct.withColumn("no", F.monotonically_increasing_id()), "names")
        found = _with_runs(known, GRAM).select("no", F.explode("runs").alias("gram"))
        runs = written(found.join(grams, "gram", "left_semi"), "name-runs")
        met = runs.join(_rarest(wanted, runs), "gram").join(known, "no")
    return met.where((F.col("keyword") == F.col("gram")) | F.contains("name", F.col("keyword"))).select("keyword", "name")


def _rarest(wanted: DataFrame, runs: DataFrame) -> DataFrame:
    """(keyword, gram): the run of each keyword that the fewest names have; a keyword with a run that no name has is in no name."""
    counts = runs.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return (
        wanted.join(counts, "gram")
        .groupBy("keyword", "n_runs")
        .agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.count(F.lit(1)).alias("found"))
        .where("found = n_runs")
        .select("keyword", "gram")
    )
