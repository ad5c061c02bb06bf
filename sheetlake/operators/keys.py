"""Finding key and metadata columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sheetlake.functions import fixed
from sheetlake.functions.scoring import key_name_score
from sheetlake.functions.text import calendar_year, contains_any, drop_na_tokens, is_filled
from sheetlake.operators.headers import exclusivity_scores
from sheetlake.operators.topn import first_n
from sheetlake.sources.catalog import Source, all_cells, cells, headers


def contains_word(words: Iterable[str]):
    """The name test used to prune columns before any data is read."""
    listed = list(words)
    return lambda name: any(w in name for w in listed)


def candidate_cells(
    sources: Iterable[Source], wanted, sample_rows: int | None = None
) -> DataFrame | None:
    """Cells of the wanted columns; missing-value texts null.

    All rows are taken, or the first ``sample_rows`` where a sampled scan is asked
    for.  Columns are dropped first, so only candidate columns are read.
    """
    sampled = []
    for s in sources:
        positions = [i for i, n in enumerate(s.header) if wanted(n)]
        if not positions:
            continue
        frame = s.frame.select(s.label, "row_no", *[f"c{i}" for i in positions])
        if sample_rows is not None and s.members:
            frame = first_n(frame, ["source"], [F.col("row_no")], sample_rows)
        elif sample_rows is not None:
            frame = frame.orderBy("row_no").limit(sample_rows)
        sampled.append(cells(replace(s, frame=frame), positions))
    if not sampled:
        return None
    return reduce(DataFrame.unionAll, sampled).withColumn("value", drop_na_tokens(F.col("value")))


def _rate(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def column_uniqueness(column_cells: DataFrame, keys: Sequence[str] = ("source", "pos", "name")) -> DataFrame:
    """Filled cells, distinct values and their ratio per column.

    Values are counted once per column before the columns are added up: a hot
    column is spread over its values, a hot value is combined on the map side.
    """
    values = column_cells.groupBy(*keys, "value").agg(F.count("value").alias("n"))
    return (
        values.groupBy(*keys)
        .agg(F.sum("n").alias("non_empty_count"), F.count("value").alias("n_distinct"))
        .withColumn("uniqueness", _rate(F.col("n_distinct"), F.col("non_empty_count")))
    )


def key_diagnostics(
    sources: Sequence[Source],
    keywords: Sequence[str] = fixed.DIAGNOSE_KEYWORDS,
    exclusions: Sequence[str] = fixed.DIAGNOSE_EXCLUSIONS,
    sample_rows: int | None = None,
    sample_values: int = fixed.SAMPLE_VALUES,
) -> DataFrame:
    """Uniqueness and example values of the columns that may be keys."""
    spark = sources[0].frame.sparkSession
    includes, excludes = contains_word(keywords), contains_word(exclusions)
    sampled = candidate_cells(sources, lambda n: includes(n) and not excludes(n), sample_rows)
    if sampled is None:
        return spark.createDataFrame(
            [], "source STRING, column_name STRING, uniqueness_rate DOUBLE, non_empty_count BIGINT, "
            "sample_values STRING"
        )
    column = ["source", "pos", "name"]
    # A file with a header and no rows still has its candidates, with nothing in them.
    heads = headers(spark, sources).filter(contains_any(F.col("name"), keywords) & ~contains_any(F.col("name"), exclusions))
    stats = heads.join(column_uniqueness(sampled), column, "left").na.fill({"uniqueness": 0.0, "non_empty_count": 0})
    firsts = (
        sampled.filter(F.col("value").isNotNull())
        .groupBy(*column, "value")
        .agg(F.min("row_no").alias("row_no"))
    )
    examples = (
        first_n(firsts, column, [F.col("row_no"), F.col("value")], sample_values)
        .groupBy(*column)
        # At most ``sample_values`` entries per list.
        .agg(F.array_sort(F.collect_list(F.struct("rank", "value"))).alias("values"))
        .select(*column, F.array_join("values.value", " | ").alias("sample_values"))
    )
    return (
        stats.join(examples, column, "left")
        .select(
            "source",
            F.col("name").alias("column_name"),
            F.round("uniqueness", 4).alias("uniqueness_rate"),
            "non_empty_count",
            F.coalesce("sample_values", F.lit("")).alias("sample_values"),
        )
        .orderBy("source", F.desc("uniqueness_rate"), "column_name")
    )


def map_key_columns(
    sources: Sequence[Source],
    trumps: Sequence[str] = fixed.KEY_TRUMPS,
    keywords: Sequence[str] = fixed.KEY_KEYWORDS,
    bonus: Sequence[str] = fixed.KEY_BONUS,
    exclusions: Sequence[str] = fixed.KEY_EXCLUSIONS,
    minimum: float = fixed.KEY_MIN_UNIQUENESS,
    sample_rows: int | None = None,
) -> DataFrame:
    """The key column of every source, null where none qualifies.

    A trump name wins when its uniqueness is above the minimum; among the
    others the best name score times uniqueness wins, the first column on ties.
    """
    spark = sources[0].frame.sparkSession
    heads = headers(spark, sources)
    catalogue = spark.createDataFrame([(n,) for s in sources for n in s.names], "source STRING")
    wanted = contains_word([*trumps, *keywords])
    sampled = candidate_cells(sources, wanted, sample_rows)
    if sampled is None:
        return catalogue.withColumn("key_column", F.lit(None).cast("string"))

    name, uniqueness = F.col("name"), F.col("uniqueness")
    trump_rank = reduce(
        lambda chain, t: chain.when(name == t[1], F.lit(len(trumps) - t[0])),
        enumerate(trumps),
        F.when(F.lit(False), F.lit(0)),
    ).otherwise(0)
    by_score = key_name_score(name, keywords, bonus, exclusions) * uniqueness
    scored = (
        heads.join(column_uniqueness(sampled), ["source", "pos", "name"])
        .withColumn("trump", F.when(uniqueness > minimum, trump_rank).otherwise(0))
        .withColumn("score", F.when((uniqueness >= minimum) & (F.col("non_empty_count") > 0), by_score))
        .filter((F.col("trump") > 0) | F.col("score").isNotNull())
    )
    best = scored.groupBy("source").agg(
        F.max_by("name", F.struct("trump", F.when(F.col("trump") == 0, F.col("score")), -F.col("pos"))).alias(
            "key_column"
        )
    )
    return catalogue.join(best, "source", "left")


def identify_metadata(
    sources: Sequence[Source],
    targets: Mapping[str, Sequence[str]] = fixed.METADATA_TARGETS,
    unique_targets: Sequence[str] = fixed.UNIQUE_TARGETS,
    year_targets: Sequence[str] = fixed.YEAR_TARGETS,
) -> DataFrame:
    """The best column per source and target; a null target where none exists."""
    spark = sources[0].frame.sparkSession
    candidates = exclusivity_scores(headers(spark, sources), targets)
    catalogue = spark.createDataFrame([(n,) for s in sources for n in s.names], "source STRING")
    wanted = contains_word([w for words in targets.values() for w in words])
    columns = ["source", "target", "column_name", "column_index", "exclusivity_score",
               "uniqueness_rate", "non_empty_rate"]
    if not any(wanted(n) for s in sources for n in s.header):
        return catalogue.select(
            "source",
            *[F.lit(None).cast(t).alias(c) for c, t in zip(
                columns[1:], ["string", "string", "int", "double", "double", "double"])],
        )
    stats = metadata_stats(all_cells(sources, wanted))
    uniqueness = F.col("n_distinct") / F.col("n_filled")
    bonus = (
        F.when(F.col("target").isin(list(unique_targets)), uniqueness)
        .when(F.col("target").isin(list(year_targets)), F.col("n_year") / F.col("n_filled"))
        .otherwise(0.0)
    )
    ranked = candidates.join(stats, ["source", "pos"]).filter(F.col("n_filled") > 0)
    chosen = ranked.groupBy("source", "target").agg(
        F.max_by(
            F.struct(
                F.col("name").alias("column_name"),
                F.col("pos").alias("column_index"),
                F.col("score").alias("exclusivity_score"),
                F.round(uniqueness, 3).alias("uniqueness_rate"),
                F.round(F.col("n_filled") / F.col("n_rows"), 3).alias("non_empty_rate"),
            ),
            F.struct(F.col("score") + bonus, -F.col("pos")),
        ).alias("best")
    )
    return catalogue.join(chosen, "source", "left").select("source", "target", "best.*")


def metadata_stats(candidates: DataFrame) -> DataFrame:
    """Rows, filled cells, distinct values and year matches per column."""
    year = calendar_year(F.col("source")).cast("string")
    filled = is_filled(F.col("value"))
    values = candidates.groupBy(
        "source", "pos", F.when(filled, F.col("value")).alias("value")
    ).agg(F.count("*").alias("n"))
    given = F.col("value").isNotNull()
    return values.groupBy("source", "pos").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(given, F.col("n"))), F.lit(0)).alias("n_filled"),
        F.count("value").alias("n_distinct"),
        F.coalesce(F.sum(F.when(given & (F.col("value") == year), F.col("n"))), F.lit(0)).alias("n_year"),
    )
