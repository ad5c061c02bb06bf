"""Incremental conversion of files: a manifest tells which are new or changed, and only those are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetlake.operators.longform import unpivot_sources
from sheetlake.sources.files import read_wide_groups

MANIFEST_SCHEMA = "path STRING, source STRING, size_bytes BIGINT, modified TIMESTAMP"


def listed_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(path, source, size_bytes, modified) of all matching files below a folder; contents unread.  Files of no bytes are not listed."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("source"),
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("modified"),
        )
    )


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the manifests that were written to the end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    numbers = [int(x.getPath().getName().removeprefix("version=")) for x in system.listStatus(path)]
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(n for n in numbers if system.exists(done(f"{folder}/version={n}/_SUCCESS")))


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files that the last finished run converted; empty before the first."""
    versions = _versions(spark, folder)
    if not versions:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/version={versions[-1]}")


def changes(listed: DataFrame, manifest: DataFrame) -> DataFrame:
    """The listed files with ``is_new``: not in the manifest, or of another size or time there."""
    known = manifest.select("path", F.col("size_bytes").alias("_size"), F.col("modified").alias("_time"))
    same = F.col("_size").eqNullSafe(F.col("size_bytes")) & F.col("_time").eqNullSafe(F.col("modified"))
    return listed.join(known, "path", "left").select("path", "source", "size_bytes", "modified", (~same).alias("is_new"))


def convert_changed(
    spark: SparkSession,
    folder: str,
    out: str,
    pattern: str = "*.csv",
    convert: Callable[[SparkSession, list[str]], DataFrame] | None = None,
    id_width: int = 3,
) -> list[str]:
    """Convert the files that are new or changed since the last run; returns their paths.

    ``convert`` makes rows with a ``source`` column of a list of paths; by default CSV files are unpivoted by their
    headers.  Output has a folder per source, and a run replaces the folders of its own sources only.  The
    manifest is written last, as a version of its own: a run that failed before is done again, and
    leaves the same rows.  File names must be unique, as they name the sources.
    """
    manifest_folder = f"{out}.manifest"
    now = changes(listed_files(spark, folder, pattern), read_manifest(spark, manifest_folder))
    rows = now.collect()
    paths = sorted(r.path for r in rows if r.is_new)
    if paths:
        if convert is None:
            groups = read_wide_groups(spark, paths)
            long = unpivot_sources(groups, id_width) if groups else None
        else:
            long = convert(spark, paths)
        if long is not None:
            (
                long.hint("rebalance", "source")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("source")
                .parquet(out)
            )
    gone = read_manifest(spark, manifest_folder).select("path").exceptAll(now.select("path")).isEmpty()
    if paths or not gone:
        number = max(_versions(spark, manifest_folder), default=0) + 1
        listing = spark.createDataFrame([(r.path, r.source, r.size_bytes, r.modified) for r in rows], MANIFEST_SCHEMA)
        listing.coalesce(1).write.mode("overwrite").parquet(f"{manifest_folder}/version={number}")
    return paths


def read_converted(spark: SparkSession, out: str) -> DataFrame:
    """The converted rows of all files that are in the manifest; those of files that went are left out."""
    rows = spark.read.option("mergeSchema", True).parquet(out).withColumn("source", F.col("source").cast("string"))
    current = read_manifest(spark, f"{out}.manifest").select("source").distinct()
    return rows.join(current, "source", "left_semi")
