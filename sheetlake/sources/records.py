"""Records of CSV files that any number of tasks may read, also where cells hold line breaks.

A file is read as lines.  A line begins a record when the number of quotes before it in its file is
even, which a running total over the lines tells; a record is then the lines up to the next such line.
No task needs more than its own slice of a file.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sheetlake.operators.ordered import laid_out, total_over
from sheetlake.sources.catalog import Source
from sheetlake.sources.files import MAX_COLUMNS

#: A field of a record that has a comma put in front of it; a quoted one may be followed by other characters.
FIELD = r'(?s),("(?:[^"]|"")*"[^,]*|[^,]*)'
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTINGS_PER_CORE = 4
OPEN_COST = "spark.sql.files.openCostInBytes"
FILES_PER_TASK = 512
QUOTED = r'(?s)^"((?:[^"]|"")*)"(.*)$'


def lines_of(spark: SparkSession, folder: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """(path, source, start, no, line): all lines as bytes; in a file they are in the order of ``start`` and ``no``.

    Folders are listed by a few tasks per core: Spark's own number is a task for every one or two folders.
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).option("lineSep", "\n")
    most, few = spark.conf.get(LISTING), LISTINGS_PER_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set(LISTING, str(min(int(most), few)))
    try:
        found = reader.text(folder)
    finally:
        spark.conf.set(LISTING, most)
    return found.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("source"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("no"),
        F.col("value").cast("binary").alias("line"),
    )


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """For what is run meanwhile, tasks read up to so many small files each; by Spark's own setting four to 32."""
    before = spark.conf.get(OPEN_COST)
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set(OPEN_COST, str(max(1, most // FILES_PER_TASK)))
    try:
        yield
    finally:
        spark.conf.set(OPEN_COST, before)


def quotes_in(line: Column) -> Column:
    """Number of quote characters; the byte is never part of another character in UTF-8 or code page 932."""
    digits = F.hex(line)
    return F.octet_length(line) - F.length(F.regexp_replace(digits, "(?:22|(..))", "$1")) / 2


def decoded(line: Column, charset: Column) -> Column:
    return F.when(charset == "MS932", F.decode(line, "MS932")).otherwise(F.decode(line, "UTF-8"))


def fields_of(record: Column) -> Column:
    """The cells of one record as text, quotes taken off."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(FIELD), F.lit(1))
    inner = lambda x: F.replace(F.regexp_extract(x, QUOTED, 1), F.lit('""'), F.lit('"'))
    return F.transform(raw, lambda x: F.when(x.startswith('"'), F.concat(inner(x), F.regexp_extract(x, QUOTED, 2))).otherwise(x))


def records_of(lines: DataFrame) -> DataFrame:
    """(path, source, record_no, record): the records of every file, numbered from 1, as bytes without their line end.

    A quote that is never closed makes the rest of its file one record.
    """
    # Both totals are over one layout, so the lines are laid out and written once.
    order = ["start", "no"]
    laid = laid_out(lines.withColumn("quotes", quotes_in(F.col("line")).cast("long")), ["path"], order)
    counted = total_over(laid, ["path"], order, F.col("quotes"), "upto")
    begins = ((F.col("upto") - F.col("quotes")) % 2 == 0).cast("int")
    numbered = total_over(counted, ["path"], order, begins, "record_no")
    parts = F.sort_array(F.collect_list(F.struct("start", "no", F.hex("line").alias("line"))))
    joined = numbered.groupBy("path", "source", "record_no").agg(parts.alias("parts"))
    text = F.unhex(F.array_join(F.transform("parts", lambda x: x["line"]), "0A"))
    ended = F.substring(text, -1, 1) == F.unhex(F.lit("0D"))
    whole = F.when(ended, F.substring(text, F.lit(1), F.octet_length(text) - 1)).otherwise(text)
    return joined.select("path", "source", "record_no", whole.alias("record"))


def read_wide_split(spark: SparkSession, path: str, charset: str | None = None, name: str | None = None) -> Source | None:
    """One CSV file as a source, read by as many tasks as it has splits; cells may hold line breaks.

    Equal to ``read_wide_csv`` but for rows, which are numbered by their record.
    """
    from sheetlake.sources.headercatalog import header_catalog

    found = header_catalog(spark, path, "*")
    row = found.files.head()
    if row is None:
        return None
    header = tuple(x.name for x in found.columns.where(F.col("header_id") == row.header_id).orderBy("pos").collect())
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
    options = {"escape": '"', "maxColumns": str(min(MAX_COLUMNS, max(20_480, 2 * len(header))))}
    text = decoded(F.col("record"), F.lit(charset or row.charset))
    records = records_of(lines_of(spark, path, "*")).where((F.col("record_no") > 1) & (F.octet_length("record") > 0))
    cells = F.from_csv(text, schema.simpleString()[len("struct<") : -1].replace(":", " "), options)
    frame = records.select((F.col("record_no") - 2).alias("row_no"), cells.alias("cells")).select("row_no", "cells.*")
    return Source(name or row.source, frame, header)
