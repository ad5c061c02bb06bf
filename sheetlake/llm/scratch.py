"""Intermediate tables that are removed as soon as what was made from them is written."""

from __future__ import annotations

from types import TracebackType

from pyspark.sql import DataFrame, SparkSession

from sheetlake.session import scratch_path


class Scratch:
    """Tables in the shared folder for the length of a ``with`` block.

    Nothing that is used after the block may still read them.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def written(self, frame: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def __exit__(
        self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None
    ) -> None:
        context = self.spark.sparkContext
        for path in self.paths:
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
