"""The headers of any number of files, parsed in tasks and stored once per distinct header."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetlake.session import written
from sheetlake.sources.files import _BOM
from sheetlake.sources.records import decoded, fields_of, lines_of, quotes_in, records_of, small_files


@dataclass(frozen=True)
class HeaderCatalog:
    """``files(path, source, charset, header_id)`` and ``columns(header_id, pos, name)``, both written."""

    files: DataFrame
    columns: DataFrame

    def headers(self) -> DataFrame:
        """The header relation ``(source, pos, name)``, with one row per file and column."""
        return self.files.select("source", "header_id").join(self.columns, "header_id").select("source", "pos", "name")

    def group_sizes(self) -> DataFrame:
        """(header_id, n_files)."""
        return self.files.groupBy("header_id").agg(F.count("*").alias("n_files"))

    def presence_count(self) -> DataFrame:
        """In how many files each name occurs, counted per header: files are never multiplied by columns."""
        names = self.columns.select("header_id", "name").distinct()
        return names.join(self.group_sizes(), "header_id").groupBy("name").agg(F.sum("n_files").alias("presence_count"))


def header_catalog(spark: SparkSession, folder: str | list[str], pattern: str = "*.csv") -> HeaderCatalog:
    """Headers of all matching files below a folder.

    A header is the first record; one that goes on in further lines is put together
    by ``records_of``, for such files only.  The charset is UTF-8 where every line of a file is, else code
    page 932.  Files without a line have no header and are left out.
    """
    lines = lines_of(spark, folder, pattern)
    first = lines.groupBy("path", "source").agg(
        F.min_by("line", F.struct("start", "no")).alias("line"),
        F.bool_and(F.is_valid_utf8(F.col("line").cast("string"))).alias("valid"),
    )
    charset = F.when(F.col("valid"), "UTF-8").otherwise("MS932").alias("charset")
    with small_files(spark):
        firsts = written(first.select("path", "source", "line", charset), "first-lines")
    open_ended = quotes_in(F.col("line")) % 2 == 1
    whole = firsts.where(~open_ended)
    others = firsts.where(open_ended).select("path", "charset")
    if not others.isEmpty():
        records = records_of(lines.join(others.select("path"), "path", "left_semi")).where("record_no = 1")
        longer = records.join(others, "path").select("path", "source", F.col("record").alias("line"), "charset")
        whole = whole.unionByName(longer)
    text = F.regexp_replace(decoded(F.col("line"), F.col("charset")), rf"\A{_BOM}|\r\z", "")
    parsed = whole.where(F.octet_length("line") > 0).select("path", "source", "charset", fields_of(text).alias("names"))
    named = written(parsed.withColumn("header_id", F.substring(F.sha2(F.to_json("names"), 256), 1, 32)), "file-headers")
    distinct = named.groupBy("header_id").agg(F.first("names").alias("names"))
    columns = distinct.select("header_id", F.posexplode("names").alias("pos", "name"))
    return HeaderCatalog(named.drop("names"), written(columns, "header-columns"))
