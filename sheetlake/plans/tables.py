"""The given tables in the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetlake.functions import fixed
from sheetlake.operators.sizes import spread_texts
from sheetlake.sources.catalog import Source

# Words searched for in document texts that stand in for header names.
DOCUMENT_KEYWORDS = {
    "project_id": ["tion", "with"],
    "project_name": ["eau", "ment"],
    "year": ["schaft", "ung "],
    "budget_amount": ["ción", "que "],
    "governing_agency": ["@", "http"],
}
TABLE_TARGETS = {
    "project_id": ["key"],
    "project_name": ["name"],
    "governing_agency": ["nation", "segment", "brand"],
    "year": ["year"],
    "budget_initial": ["price"],
    "budget_supplementary": ["bal"],
    "expenditure_final": ["status", "priority", "type"],
}
TABLE_KEY_WORDS = ("key", "name", "date", "type")
TABLE_KEY_EXCLUSIONS = ("nation",)
ORDERS_FILE = "orders_2000.csv"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(docs: DataFrame) -> DataFrame:
    """Documents placed by id: a file of one row group, or of a few long texts, is many tasks of bounded size."""
    return spread_texts(docs, "id", "contents")


def as_text(column: Column, kind: str) -> Column:
    """Fixed text form: two decimals for doubles, the day for timestamps."""
    if kind == "double":
        return column.cast("decimal(18,2)").cast("string")
    if kind.startswith("timestamp"):
        return F.date_format(column, "yyyy-MM-dd")
    return column.cast("string")


def text_table(frame: DataFrame) -> DataFrame:
    return frame.select(*[as_text(F.col(c), t).alias(c) for c, t in frame.dtypes])


def table_source(
    spark: SparkSession, folder: str, name: str, columns: list[str] | None = None, file_name: str | None = None
) -> Source:
    """A table as a wide source; its first column gives the row order."""
    frame = table(spark, folder, name)
    if columns:
        frame = frame.select(*columns)
    order = F.col(frame.columns[0])
    ordered = frame.select(order.alias("row_no"), *[as_text(F.col(c), t).alias(c) for c, t in frame.dtypes])
    numbered = ordered.select("row_no", *[F.col(c).alias(f"c{i}") for i, c in enumerate(frame.columns)])
    return Source(file_name or name, numbered, tuple(frame.columns))


def orders_with_year(spark: SparkSession, folder: str) -> Source:
    frame = table(spark, folder, "orders").withColumn("o_orderyear", F.year("o_orderdate"))
    texts = [as_text(F.col(c), t).alias(f"c{i}") for i, (c, t) in enumerate(frame.dtypes)]
    return Source(ORDERS_FILE, frame.select(F.col("o_orderkey").alias("row_no"), *texts), tuple(frame.columns))


def pick(number: Column, choices: list[Column]) -> Column:
    """The choice of the given number, counted from one."""
    chain = F.when(number == 1, choices[0])
    for i, choice in enumerate(choices[1:], start=2):
        chain = chain.when(number == i, choice)
    return chain


def document_headers(spark: SparkSession, folder: str, source: str = "source") -> DataFrame:
    """Document texts as header names, the document's source as their file."""
    return table(spark, folder, "documents").select(
        F.col(source).alias("source"), F.col("doc_id").cast("int").alias("pos"), F.col("text").alias("name")
    )


def order_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a file, its line numbers as columns."""
    # Numbers keep the aggregate on hash tables; text would have to be sorted.
    flag = F.concat_ws("-", F.char(F.max(F.ascii("l_returnflag"))), F.max("l_quantity").cast("int").cast("string"))
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(flag.alias("name"))
        .select(F.col("l_orderkey").cast("string").alias("source"), F.col("l_linenumber").alias("pos"), "name")
    )


def amount_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as header names of several kinds, the ship year as file."""
    kinds = [
        F.concat(F.lit("支出先-"), F.col("l_returnflag"), F.lit("-支出額（百万円）"), F.col("l_suppkey")),
        F.concat(F.lit("執行額"), F.col("l_suppkey")),
        F.concat(F.lit("支出先の評価"), F.col("l_suppkey")),
        F.concat(F.lit("支出済額-"), F.col("l_suppkey")),
        F.concat(F.lit("支出"), F.col("l_suppkey"), F.lit("額の説明は妥当か。")),
        F.concat(F.lit("予算-支出額-"), F.col("l_suppkey"), F.lit("執行額")),
        F.concat(F.lit("支出"), F.col("l_suppkey")),
    ]
    name = pick(F.col("l_linenumber"), kinds)
    return table(spark, folder, "lineitem").select(
        F.year("l_shipdate").cast("string").alias("source"), F.col("l_linenumber").alias("pos"), name.alias("name")
    )


def long_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as long rows whose names have every shape of hierarchy."""
    number = F.col("l_linenumber").cast("string")
    shapes = [
        F.concat(F.lit("支出先上位10者リスト-"), F.col("l_returnflag"), F.lit(".支払先-"), number,
                 F.lit("-支出額（百万円）")),
        F.concat(F.lit("支出先上位10者リスト-A.支払先-"), number, F.lit("-契約-方式")),
        F.concat(F.lit("支出先上位10者リスト-A.支払先-"), number),
        F.lit("支出先上位10者リスト-A.支払先-x-金額"),
        F.concat(F.lit("予算-グループ-金額-"), number),
        F.lit("予算-グループ-金額"),
        F.concat(F.lit("事業名"), F.col("l_linestatus")),
    ]
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("database"), F.year("l_shipdate").cast("string"), F.lit(".csv")).alias("source"),
        F.col("l_orderkey").cast("string").alias(fixed.ID_PARTS[0]),
        pick(F.col("l_linenumber"), shapes).alias("original_column_name"),
        as_text(F.col("l_extendedprice"), "double").alias("value"),
    )


def long_by_order_priority(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as long rows of few, very long records: one per year and priority."""
    return table(spark, folder, "orders").select(
        F.concat(F.lit("database"), F.year("o_orderdate").cast("string"), F.lit(".csv")).alias("source"),
        F.col("o_orderpriority").alias(fixed.ID_PARTS[0]),
        F.concat(F.lit("注文-"), F.col("o_orderstatus")).alias("original_column_name"),
        as_text(F.col("o_totalprice"), "double").alias("value"),
    )


def wide_lineitem(spark: SparkSession, folder: str) -> Source:
    """One row per order with repeated columns per line number.

    Returned lines go to block B, the others to block A.
    """
    block = F.when(F.col("l_returnflag") == "R", "B").otherwise("A")
    fields = {
        "支出額（百万円）": ("l_extendedprice", "double"),
        "支出先": ("l_suppkey", "bigint"),
        "法人番号": ("l_partkey", "bigint"),
        "落札率": ("l_discount", "double"),
    }
    names, highest, texts = ["l_orderkey", "n_lines"], [], []
    for letter in ("A", "B"):
        for number in range(1, 8):
            here = (block == letter) & (F.col("l_linenumber") == number)
            for attribute, (column, kind) in fields.items():
                place = f"c{len(names)}"
                highest.append(F.max(F.when(here, F.col(column))).alias(place))
                texts.append(as_text(F.col(place), kind).alias(place))
                names.append(f"支出先上位10者リスト-{letter}.支払先-{number}-{attribute}")
    wide = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("c1"), *highest)
    keyed = wide.select(
        F.col("l_orderkey").alias("row_no"),
        F.col("l_orderkey").cast("string").alias("c0"),
        F.col("c1").cast("string").alias("c1"),
        *texts,
    )
    return Source("lineitem.csv", keyed, tuple(names))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("contents")
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "embedding")


def passages(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages as keyword queries."""
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def passage_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The vector of the same number for every passage that has one."""
    asked = passages(spark, folder).select("query_id")
    embedded = table(spark, folder, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    return asked.join(embedded, "query_id")


#: (table, columns, keys per file) of tables that are written as very many small files.
MANY_FILES = (
    ("orders", ["o_orderkey", "o_custkey", "o_orderstatus"], 200),
    ("customer", ["c_custkey", "c_name", "c_nationkey"], 20),
    ("part", ["p_partkey", "p_name"], 20),
)
