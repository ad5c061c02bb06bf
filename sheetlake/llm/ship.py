"""Prepares a session for task functions: modules on the executors, and batches of whole texts that stay small."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Rows of a batch that goes to a task function; Spark's own default is made for rows of a few numbers.
BATCH_ROWS = "1000"
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SPARK_DEFAULT = "10000"

_PACKAGE = Path(__file__).resolve().parent.parent
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once per application, and bound the batches.

    Executors that can import it by themselves lose nothing; others need no copy of it.
    A batch size that was set to another value than Spark's default is left alone.
    """
    context = spark.sparkContext
    if spark.conf.get(_BATCH_SETTING) == _SPARK_DEFAULT:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
    if context.applicationId in _sent or not _PACKAGE.is_dir():
        return
    _sent.add(context.applicationId)
    archive = Path(tempfile.mkdtemp(prefix="sheetlake-")) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(_PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
