"""Writers. Each one replaces what was there unless it says otherwise."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def save_csv(frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report or separated table as CSV with a header line (no byte-order mark); cells keep white space at their ends."""
    writer = frame.write.mode(mode).option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def save_many_csv(frame: DataFrame, path: str, key: str, tasks_per_core: int = 4) -> None:
    """One CSV file with a header line per value of ``key``, for very many values.

    The files are made by as many tasks as there are cores for, however few bytes they hold, and each task moves its own into
    place: the driver would move them one by one.  A write that fails may leave files there.
    In a folder of the machines' own file system tasks write the files themselves (``_files_of``).
    """
    tasks = tasks_per_core * frame.sparkSession.sparkContext.defaultParallelism
    _, system = _path(frame.sparkSession, path)
    if system.getUri().getScheme() == "file" and len(frame.columns) > 2:
        return _save_files(frame, path, key, tasks)
    writer = frame.repartition(tasks, key).write.partitionBy(key).option("header", True)
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").csv(path)


def _save_files(frame: DataFrame, path: str, key: str, tasks: int) -> None:
    """``save_many_csv`` in a folder that all machines have mounted, with Spark's folders and lines."""
    spark = frame.sparkSession
    target, system = _path(spark, path)
    if system.exists(target):
        raise FileExistsError(path)
    names = [c for c in frame.columns if c != key]
    header = spark.range(1).select(F.to_csv(F.struct(*[F.lit(n).alias(f"c{i}") for i, n in enumerate(names)]))).head()[0]
    value = F.nullif(F.col(f"`{key}`").cast("string"), F.lit(""))
    line = F.to_csv(F.struct(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]))
    # Dealt by the folder's name: keys that share it, as null and empty text do, share a file.
    rows = frame.select(value.alias("value"), line.alias("line")).repartition(tasks, "value").sortWithinPartitions("value")
    system.mkdirs(target)
    work = _files_of(target.toUri().getPath(), key, header)
    rows.mapInArrow(work, "n long").write.format("noop").mode("overwrite").save()
    system.create(_path(spark, f"{path}/_SUCCESS")[0]).close()


def _files_of(folder: str, key: str, header: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes a file for each run of equal values of a task's rows ``(value, line)``.

    Without Hadoop's native library each file and folder that it makes there costs it a process that sets permissions.
    A file gets its name when it is whole, so a task that runs twice does no harm.
    """

    def safe(text: str) -> str:
        return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^\x7f" or "\0" < c < " " else c for c in text)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def named(value: str | None) -> str:
            return os.path.join(folder, f"{safe(key)}={'__HIVE_DEFAULT_PARTITION__' if value is None else safe(value)}")

        out, place, count = None, None, 0

        def end() -> None:
            out.close()
            os.replace(out.name, os.path.join(place, "part-00000.csv"))

        for batch in batches:
            values, lines = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first = 0
            while first < len(values):
                last = first + 1
                while last < len(values) and values[last] == values[first]:
                    last += 1
                if place != named(values[first]):
                    if out is not None:
                        end()
                    place = named(values[first])
                    os.makedirs(place, exist_ok=True)
                    out = open(os.path.join(place, f"_part-{uuid.uuid4().hex}"), "wb")
                    out.write(f"{header}\n".encode())
                    count += 1
                out.write("".join(f"{x}\n" for x in lines[first:last]).encode())
                first = last
        if out is not None:
            end()
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["n"])

    return write


def save_long(frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Long rows as Parquet, one partition folder per source.

    Rows are rebalanced by source before writing: adaptive execution joins the rows of small
    sources and splits a hot one by size, so there are few files and no
    task holds a hot source.
    """
    (
        frame.hint("rebalance", "source")
        .write.mode(mode)
        .partitionBy("source")
        .parquet(path)
    )


def save_table(frame: DataFrame, name: str, mode: str = "overwrite") -> None:
    frame.write.mode(mode).saveAsTable(name)


def replace_view(frame: DataFrame, name: str) -> None:
    frame.createOrReplaceTempView(name)


def fingerprint(frame: DataFrame, *settings: object) -> str:
    """Row count and an order-free sum of row hashes, with the settings: equal input has an equal one."""
    found = frame.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64(*frame.columns).cast("decimal(38,0)")), F.lit(0)).alias("sum")
    ).head()
    return ":".join(map(str, (found.n, found.sum, *settings)))


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_finished(spark: SparkSession, path: str, mark: str) -> bool:
    """Whether the output of a completed job with this mark is there."""
    done, system = _path(spark, f"{path}/_SUCCESS")
    made_of, _ = _path(spark, f"{path}.made_of/_SUCCESS")
    if not (system.exists(done) and system.exists(made_of)):
        return False
    return [r.value for r in spark.read.text(f"{path}.made_of").collect()] == [mark]


def save_documents(frame: DataFrame, path: str, made_of: str | None = None) -> None:
    """Documents or chunks as JSON Lines.

    With ``made_of``, the fingerprint of input and settings, finished output of the
    same input is left alone; what a failed job left, or output of other input, is replaced.
    """
    spark = frame.sparkSession
    if made_of is not None and is_finished(spark, path, made_of):
        return
    if made_of is not None:
        old, system = _path(spark, f"{path}.made_of")
        system.delete(old, True)
    frame.select("id", "contents").write.mode("overwrite").json(path)
    if made_of is not None:
        spark.createDataFrame([(made_of,)], "value STRING").coalesce(1).write.mode("overwrite").text(f"{path}.made_of")


def save_report(frame: DataFrame, path: str) -> None:
    """A report as JSON Lines; text outside ASCII stays readable."""
    frame.write.mode("overwrite").json(path)


def save_key_map(frame: DataFrame, path: str) -> None:
    """Key map rows; sources without a key column keep a null entry."""
    frame.select("source", "key_column").write.mode("overwrite").option(
        "ignoreNullFields", False
    ).json(path)


def describe_table(spark: SparkSession, name: str) -> tuple[list[tuple[str, str]], int]:
    """Column names with types, and the row count, of a stored table."""
    table = spark.table(name)
    return table.dtypes, table.count()
