"""From wide files to a key map and separated tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from sheetlake.operators.keys import map_key_columns
from sheetlake.operators.separate import separate, separate_groups
from sheetlake.sources import files, sinks


def separate_folder(
    spark: SparkSession, csv_folder: str, out_folder: str, key_pattern: str = "*.csv"
) -> None:
    """Find every file's key column, then write main and child tables."""
    sources = files.read_wide_folder(spark, csv_folder)
    keyed = {r.source for r in files.list_sources(spark, csv_folder, key_pattern).select("source").collect()}
    key_map = map_key_columns([s for s in sources if s.name in keyed])
    sinks.save_key_map(key_map, f"{out_folder}/key_map")
    mains, children = separate(sources, files.read_key_rows(spark, f"{out_folder}/key_map"))
    for name, main in mains.items():
        sinks.save_csv(main, f"{out_folder}/main/{name.removesuffix('.csv')}")
    if children is not None:
        sinks.save_csv(children, f"{out_folder}/children")


def separate_many(spark: SparkSession, csv_folder: str, out_folder: str, key_pattern: str = "*.csv") -> None:
    """The same for any number of files: one branch per header, one write of all main rows and one of all child rows.

    Main rows are Parquet in a folder per source.
    """
    groups = files.read_wide_groups(spark, csv_folder)
    key_map = map_key_columns(groups).join(files.list_sources(spark, csv_folder, key_pattern).select("source"), "source", "left_semi")
    sinks.save_key_map(key_map, f"{out_folder}/key_map")
    mains, children = separate_groups(groups, files.read_key_rows(spark, f"{out_folder}/key_map"))
    if mains is not None:
        sinks.save_long(mains, f"{out_folder}/main")
    if children is not None:
        children.write.mode("overwrite").parquet(f"{out_folder}/children")
