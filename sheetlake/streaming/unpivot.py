"""Incremental unpivot: new files are turned into long rows as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sheetlake.operators.longform import unpivot_frame


def stream_files(
    spark: SparkSession, folder: str, schema: StructType, file_format: str = "csv", pattern: str = "*.csv"
) -> DataFrame:
    """A streaming frame over the files of a folder; the schema is given.

    A CSV file whose header differs from the schema stops the stream instead of
    giving its values wrong names: files of another header are another stream.
    """
    return (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", pattern)
        .load(folder)
    )


def unpivot_stream(
    stream: DataFrame,
    id_columns: Sequence[str],
    columns: Sequence[str],
    out: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda long: long,
) -> DataFrame:
    """Process all files that are there, then stop; returns the rows written so far.

    Every step is stateless.  A later call with the same checkpoint takes only
    files that are new; a call after a failure takes up where the last one
    ended, and the file sink keeps each row once.
    """
    long = transform(unpivot_frame(stream, id_columns, columns))
    query = (
        long.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(long.schema).parquet(out)
