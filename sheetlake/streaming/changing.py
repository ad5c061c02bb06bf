"""Incremental unpivot of files whose headers change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetlake.operators.longform import unpivot_sources
from sheetlake.sources.files import read_wide_groups

#: Files of one micro-batch: their paths reach the driver, as any read of files lists them there.
BATCH_FILES = 1000


def unpivot_changing_stream(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    id_width: int = 3,
    pattern: str = "*.csv",
    batch_files: int = BATCH_FILES,
) -> DataFrame:
    """Unpivot all new files of a folder, each by its own header; returns the long rows written so far.

    The stream carries the files' paths, not their contents.  A micro-batch groups its files by
    header, so a new column, or one that moved, needs no new stream.  It writes the folder of its number, whole
    or anew: a batch that is repeated after a failure replaces what it left, and no row comes twice.
    Files without a row below their header give nothing.
    """
    listed = (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", batch_files)
        .load(folder)
        .select("path")
    )

    def write(batch: DataFrame, number: int) -> None:
        paths = sorted(r.path for r in batch.collect())
        groups = read_wide_groups(batch.sparkSession, paths) if paths else []
        if groups:
            unpivot_sources(groups, id_width).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        listed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.option("mergeSchema", True).option("basePath", out).parquet(out).drop("batch")
