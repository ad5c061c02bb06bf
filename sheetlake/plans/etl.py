"""From wide files to the clean long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from sheetlake.functions import fixed
from sheetlake.operators.longform import clean_long_data, unpivot_sources
from sheetlake.sources import files, sinks


def clean_long_from_folder(
    spark: SparkSession, folder: str, id_parts: Sequence[str] = fixed.ID_PARTS
) -> DataFrame:
    """All CSV files of a folder to clean long rows, in one plan without a shuffle."""
    return clean_long_data(unpivot_sources(files.read_wide_groups(spark, folder)), id_parts)


def load_clean_table(
    spark: SparkSession,
    csv_folder: str,
    parquet_folder: str,
    table: str,
    id_parts: Sequence[str] = fixed.ID_PARTS,
) -> tuple[list[tuple[str, str]], int]:
    """Files to long Parquet to a stored clean table; returns its columns and row count."""
    sinks.save_long(unpivot_sources(files.read_wide_groups(spark, csv_folder)), parquet_folder)
    sinks.save_table(clean_long_data(files.read_long_parquet(spark, parquet_folder), id_parts), table)
    return sinks.describe_table(spark, table)
