"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Lets the CSV reader take code page 932 for sources that are not UTF-8.
    "spark.sql.legacy.javaCharsets": "true",
    # Very wide unpivots: keep generated code for wide projections.
    "spark.sql.codegen.maxFields": "400",
}


def session(app_name: str = "sheetlake", **extra: str) -> SparkSession:
    """A session with the recommended settings; ``extra`` uses ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    A cluster names a folder that all executors reach in
    ``spark.checkpoint.dir``.  Where nothing is set, a local master gets a temporary
    folder; any other is refused, as its machines would not share one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not folder and not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = folder or tempfile.mkdtemp(prefix="sheetlake-")
        spark.sparkContext.setCheckpointDir(folder)
        current = spark.sparkContext.getCheckpointDir()
    return (folder or current).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have an existing path removed when the session's JVM ends."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    For results that several later steps must see unchanged: nothing is
    computed twice, and a lost executor only means reading again.  The folder is
    removed when the session ends.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    remove_at_end(frame.sparkSession, path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
