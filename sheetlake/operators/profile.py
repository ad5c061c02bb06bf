"""Profiles of headers and cells: metrics, length bins, column types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sheetlake.functions import fixed
from sheetlake.functions.cells import CELL_TYPES, bin_label, bin_labels, bin_number, cell_type, dominant_type

MEGABYTE = 1024 * 1024


# --- source metrics ----------------------------------------------------------
def source_metrics(headers: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Column count and longest header per source, with the size if known.

    ``sizes`` is ``(source, size_bytes)``, as the file listing gives it.
    """
    metrics = headers.groupBy("source").agg(
        F.count("*").alias("column_count"),
        F.max(F.length("name")).alias("max_header_length"),
    )
    if sizes is None:
        return metrics
    megabytes = F.round(F.col("size_bytes") / MEGABYTE, 2).alias("file_size_mb")
    return metrics.join(sizes.select("source", megabytes), "source", "left")


def source_summary(metrics: DataFrame) -> DataFrame:
    """One row over all sources."""
    total_size = (
        [F.round(F.sum("file_size_mb"), 2).alias("total_size_mb")] if "file_size_mb" in metrics.columns else []
    )
    return metrics.agg(
        F.count("*").alias("n_sources"),
        *total_size,
        F.max("column_count").alias("max_columns"),
        F.min("column_count").alias("min_columns"),
        F.avg("column_count").alias("avg_columns"),
        F.max("max_header_length").alias("max_header_length"),
    )


# --- lengths -----------------------------------------------------------------
def length_counts(
    headers: DataFrame, cells: DataFrame, bins: Sequence[int] = fixed.LENGTH_BINS
) -> DataFrame:
    """The one pass all length reports come from.

    One row per source, kind and bin with count, longest and total length; the
    result has at most ``2 * (bins + 1)`` rows per source.
    """
    def lengths(frame: DataFrame, text: str, kind: str) -> DataFrame:
        return frame.select("source", F.lit(kind).alias("kind"), F.length(text).alias("length"))

    both = lengths(headers, "name", "header").unionAll(lengths(cells, "value", "cell"))
    return both.groupBy("source", "kind", bin_number(F.col("length"), bins).alias("bin_no")).agg(
        F.count("*").alias("n"),
        F.max("length").alias("max_len"),
        F.sum("length").alias("total_len"),
    )


def length_bins(counts: DataFrame, bins: Sequence[int] = fixed.LENGTH_BINS) -> DataFrame:
    """Non-empty bins per source and kind."""
    return counts.select("source", "kind", "bin_no", bin_label(F.col("bin_no"), bins).alias("bin"), "n")


def length_metrics(counts: DataFrame) -> DataFrame:
    """Per source: counts, longest and average lengths of headers and cells."""
    def only(kind: str, value: str) -> Column:
        return F.when(F.col("kind") == kind, F.col(value))

    def count(kind: str) -> Column:
        return F.coalesce(F.sum(only(kind, "n")), F.lit(0))

    def longest(kind: str) -> Column:
        return F.coalesce(F.max(only(kind, "max_len")), F.lit(0))

    def average(kind: str) -> Column:
        mean = F.sum(only(kind, "total_len")) / F.sum(only(kind, "n"))
        return F.coalesce(F.round(mean, 1), F.lit(0.0))

    return counts.groupBy("source").agg(
        count("header").alias("column_count"),
        count("cell").alias("cell_count"),
        longest("header").alias("max_header_len"),
        average("header").alias("avg_header_len"),
        longest("cell").alias("max_cell_len"),
        average("cell").alias("avg_cell_len"),
    )


def length_summary(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.max("max_cell_len").alias("max_cell_len_overall"),
        F.max("max_header_len").alias("max_header_len_overall"),
    )


def length_matrix(
    counts: DataFrame, sources: Sequence[str], kind: str = "cell", bins: Sequence[int] = fixed.LENGTH_BINS
) -> DataFrame:
    """One row per bin, one column per source, zero where a source has none.

    Only bins that occur in some source are shown, in bin order.
    """
    wide = (
        counts.filter(F.col("kind") == kind)
        .groupBy("bin_no")
        .pivot("source", list(sources))
        .agg(F.sum("n"))
        .na.fill(0)
    )
    return wide.withColumn("bin", bin_label(F.col("bin_no"), bins)).orderBy("bin_no")


def source_matrix(
    counts: DataFrame, kind: str = "cell", bins: Sequence[int] = fixed.LENGTH_BINS
) -> DataFrame:
    """The same matrix turned: one row per source, one column per bin.

    The bins are known beforehand, so this form holds for any number of sources.
    """
    labels = bin_labels(bins)
    wide = (
        counts.filter(F.col("kind") == kind)
        .groupBy("source")
        .pivot("bin_no", list(range(len(labels))))
        .agg(F.sum("n"))
        .na.fill(0)
    )
    return wide.select("source", *[F.col(str(i)).alias(f"len_{label}") for i, label in enumerate(labels)])


def distribution_report(counts: DataFrame, bins: Sequence[int] = fixed.LENGTH_BINS) -> DataFrame:
    """Metrics per source with two maps ``bin -> count``."""
    def bin_map(kind: str) -> Column:
        entries = F.collect_list(
            F.when(F.col("kind") == kind, F.struct("bin_no", bin_label(F.col("bin_no"), bins).alias("bin"), "n"))
        )
        return F.map_from_entries(
            F.transform(F.array_sort(entries), lambda e: F.struct(e["bin"], e["n"]))
        )

    # At most bins + 1 rows per source and kind reach each list.
    maps = counts.groupBy("source").agg(
        bin_map("header").alias("header_len_distribution"),
        bin_map("cell").alias("cell_len_distribution"),
    )
    return length_metrics(counts).join(maps, "source")


def scalar_columns(report: DataFrame) -> DataFrame:
    """A report without its map columns."""
    return report.select(*[c for c, t in report.dtypes if not t.startswith("map<")])


# --- column types ------------------------------------------------------------
def column_type_counts(cells: DataFrame) -> DataFrame:
    """Per column: cells of each type, longest and total lengths."""
    kind, length = F.col("kind"), F.col("length")
    typed = cells.select(
        "source", "pos", "name", cell_type(F.col("value")).alias("kind"), F.length("value").alias("length")
    )
    return typed.groupBy("source", "pos", "name").agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(kind == t).alias(f"n_{t}") for t in CELL_TYPES],
        F.max("length").alias("max_len"),
        F.sum("length").alias("total_len"),
        F.coalesce(F.sum(F.when(kind != "empty", length)), F.lit(0)).alias("non_empty_len"),
    )


def source_sizes(headers: DataFrame, counts: DataFrame) -> DataFrame:
    """Columns and rows per source; a source with a header and no rows has 0 rows."""
    columns = headers.groupBy("source").agg(F.count("*").alias("column_count"))
    rows = counts.groupBy("source").agg(F.max("n_rows").alias("row_count"))
    return columns.join(rows, "source", "left").na.fill({"row_count": 0})


def with_dominant_type(counts: DataFrame, threshold: float = fixed.DOMINANCE) -> DataFrame:
    label = dominant_type(
        *[F.col(c) for c in ("n_rows", "n_empty", "n_int", "n_float", "n_bool", "n_text")], threshold
    )
    return counts.withColumn("dominant_type", label)


def column_type_summary(counts: DataFrame, threshold: float = fixed.DOMINANCE) -> DataFrame:
    """Per source and dominant type: how many columns and how full they are."""
    filled = F.sum("n_rows") - F.sum("n_empty")
    return with_dominant_type(counts, threshold).groupBy("source", "dominant_type").agg(
        F.count("*").alias("column_count"),
        F.round(F.sum("n_empty") / F.sum("n_rows"), 3).alias("avg_empty_rate"),
        F.max("max_len").alias("overall_max_cell_len"),
        F.round(F.sum("total_len") / F.sum("n_rows"), 2).alias("avg_cell_len"),
        F.when(filled > 0, F.round(F.sum("non_empty_len") / filled, 2))
        .otherwise(0.0)
        .alias("avg_non_empty_cell_len"),
    )
