"""Readers for the file formats the jobs start from."""

from __future__ import annotations

import csv
import os

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sheetlake.sources.catalog import HEADER_SCHEMA, Source

DOCUMENT_SCHEMA = "id STRING, contents STRING"
KEY_MAP_SCHEMA = "source STRING, key_column STRING"
_BOM = "\ufeff"
MAX_COLUMNS = 1_000_000


def list_sources(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``(source, path, size_bytes)`` of the files that match, contents unread."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("source"),
            "path",
            F.col("length").alias("size_bytes"),
        )
    )


def first_lines(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``(path, source, line, charset)`` of all matching files, in one job over all their lines.

    ``line`` is the first line as bytes.  The charset is ``UTF-8`` when every line decodes as
    such, else code page 932: a header in ASCII says nothing about the rows below it.
    """
    lines = spark.read.option("pathGlobFilter", pattern).text(folder).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("source"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("no"),
        "value",
    )
    return (
        lines.groupBy("path", "source")
        .agg(
            F.min_by(F.col("value").cast("binary"), F.struct("start", "no")).alias("line"),
            F.bool_and(F.is_valid_utf8("value")).alias("valid"),
        )
        .select("path", "source", "line", F.when(F.col("valid"), "UTF-8").otherwise("MS932").alias("charset"))
    )


def detect_charset(spark: SparkSession, path: str) -> str:
    """``UTF-8`` when all lines of the file decode as such, else code page 932."""
    found = first_lines(spark, path, "*").head()
    return "UTF-8" if found is None else found.charset


def read_header(
    spark: SparkSession, path: str, charset: str = "UTF-8", multi_line: bool = True
) -> tuple[str, ...]:
    """Column names as written, repeated names included; reads one record."""
    row = (
        spark.read.option("header", False)
        .option("multiLine", multi_line)
        .option("maxColumns", MAX_COLUMNS)
        .option("escape", '"')
        .option("encoding", charset)
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .csv(path)
        .head()
    )
    if row is None:
        return ()
    names = ["" if v is None else v for v in row]
    names[0] = names[0].removeprefix(_BOM)
    # A line break inside a name can hide that lines end in two characters.
    names[-1] = names[-1].removesuffix("\r")
    return tuple(names)


def parse_header(line: bytes, charset: str) -> tuple[str, ...] | None:
    """Column names from a first line; None when a name goes on in the next line."""
    text = line.decode("cp932" if charset == "MS932" else "utf-8", "replace").removeprefix(_BOM)
    if text.count('"') % 2:
        return None
    return tuple(next(csv.reader([text]), ()))


def _files(spark: SparkSession, folder: str, pattern: str, charset: str | None, multi_line: bool):
    """(path, source, header, charset) of all files with a header, in name order."""
    for row in first_lines(spark, folder, pattern).orderBy("source", "path").collect():
        used = charset or row.charset
        header = parse_header(bytes(row.line), used)
        if header is None:
            header = read_header(spark, row.path, used, multi_line)
        if header:
            yield row.path, row.source, header, used


def _read(spark: SparkSession, paths: list[str], header: tuple[str, ...], charset: str, multi_line: bool) -> DataFrame:
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
    frame = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE" if multi_line else "FAILFAST")
        .option("maxColumns", max(20_480, 2 * len(header)))
        .option("encoding", charset)
        .option("escape", '"')
        .csv(paths)
    )
    source = F.col("_metadata.file_name").alias("source")
    last = f"c{len(header) - 1}"
    if not multi_line:
        return frame.select(F.monotonically_increasing_id().alias("row_no"), "*", source)
    trimmed = F.regexp_replace(last, r"\r\z", "")
    kept = [F.col(f"c{i}") for i in range(len(header) - 1)]
    return frame.select(
        F.monotonically_increasing_id().alias("row_no"), *kept, F.when(trimmed != "", trimmed).alias(last), source
    )


def read_wide_csv(
    spark: SparkSession,
    path: str,
    name: str | None = None,
    charset: str | None = None,
    multi_line: bool = True,
) -> Source | None:
    """One CSV file as a source; all columns text, no inference.

    Cells may hold line breaks.  Without ``multi_line`` every line is a record, so that a
    file can be split among tasks; a line that is no whole record then fails the
    read instead of losing cells.
    """
    charset = charset or detect_charset(spark, path)
    header = read_header(spark, path, charset, multi_line)
    if not header:
        return None
    frame = _read(spark, [path], header, charset, multi_line).drop("source")
    return Source(name or os.path.basename(path), frame, header)


def read_wide_folder(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    charset: str | None = None,
    multi_line: bool = True,
) -> list[Source]:
    """All matching CSV files of a folder, one source each, in name order."""
    return [
        Source(source, _read(spark, [path], header, used, multi_line).drop("source"), header)
        for path, source, header, used in _files(spark, folder, pattern, charset, multi_line)
    ]


def read_wide_groups(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    charset: str | None = None,
    multi_line: bool = True,
) -> list[Source]:
    """All matching CSV files of a folder, one source and one read per distinct header and charset.

    The plan grows with the number of headers, not of files.
    """
    groups: dict[tuple, list[tuple[str, str]]] = {}
    for path, source, header, used in _files(spark, folder, pattern, charset, multi_line):
        groups.setdefault((header, used), []).append((path, source))
    return [
        Source(
            members[0][1],
            _read(spark, [path for path, _ in members], header, used, multi_line),
            header,
            tuple(source for _, source in members),
        )
        for (header, used), members in groups.items()
    ]


def read_headers(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Header relation of a folder without building the sources."""
    found = _files(spark, folder, pattern, None, True)
    rows = [(source, i, n) for _, source, header, _ in found for i, n in enumerate(header)]
    return spark.createDataFrame(rows, HEADER_SCHEMA)


def read_long_csv(spark: SparkSession, path: str, source: str) -> DataFrame:
    """A long CSV (id parts, original column name, value), all text."""
    wide = read_wide_csv(spark, path, source)
    return wide.named().withColumn("source", F.lit(source))


def read_long_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Long Parquet files, columns united by name.

    Folders written by ``save_long`` carry ``source`` as a partition column;
    plain files get the base name of their path.
    """
    frame = (
        spark.read.option("mergeSchema", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(path)
    )
    if "source" in frame.columns:
        return frame.withColumn("source", F.col("source").cast("string"))
    base = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return frame.select("*", base.alias("source"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines documents ``(id, contents)``."""
    return spark.read.schema(DOCUMENT_SCHEMA).json(path)


def read_key_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object ``{source: key column or null}`` as rows."""
    text = spark.read.text(path, wholetext=True)
    return text.select(
        F.explode(F.from_json("value", "MAP<STRING,STRING>")).alias("source", "key_column")
    )


def read_key_rows(spark: SparkSession, path: str) -> DataFrame:
    """Key map rows as ``save_key_map`` writes them."""
    return spark.read.schema(KEY_MAP_SCHEMA).json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A report: either an array of objects or JSON Lines."""
    return spark.read.option("multiLine", True).json(path)


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """A small report CSV with its column types inferred (the header matrix)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)
