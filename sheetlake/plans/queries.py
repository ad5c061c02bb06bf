"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetlake.functions import fixed
from sheetlake.functions.headerpath import with_header_path
from sheetlake.functions.text import calendar_year, file_safe_name, first_year, sheet_safe_name
from sheetlake.operators import (
    bitmaps,
    containment,
    corpus,
    headers,
    hybrid,
    keys,
    longform,
    profile,
    separate,
    sketches,
    vectors,
    vectorstore,
)
from sheetlake.operators.bm25 import KeywordIndex, bm25_search as bm25_search_in
from sheetlake.plans import tables as t
from sheetlake.plans.answer import search_documents
from sheetlake.plans.index import index_documents
from sheetlake.session import remove_at_end, scratch_path
from sheetlake.sources import catalog, files, headercatalog, manifest, records, sinks
from sheetlake.sources.catalog import Source
from sheetlake.streaming.changing import unpivot_changing_stream
from sheetlake.streaming.unpivot import stream_files, unpivot_stream

Query = Callable[[SparkSession, str], DataFrame]
CHUNK_BYTES = 2_000
PART_BYTES = 2_000
_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- long form -----------------------------------------------------------------
@query
def clean_cells(spark, folder):
    return longform.clean_cells(t.table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))


@query
def safe_names(spark, folder):
    url = F.col("url")
    return t.table(spark, folder, "pages").select(
        "page_id", sheet_safe_name(url).alias("sheet_name"), file_safe_name(url).alias("file_name")
    )


@query
def unpivot_wide(spark, folder):
    return longform.unpivot_source(t.table_source(spark, folder, "orders"))


@query
def composite_id(spark, folder):
    parts = ["l_orderkey", "事業番号-2", "l_linenumber"]
    return longform.with_business_id(t.table(spark, folder, "lineitem"), parts).select(
        "business_id", "l_partkey", "l_suppkey"
    )


@query
def parse_header_path(spark, folder):
    return with_header_path(t.long_lineitem(spark, folder)).select(
        "original_column_name", "concept", "block", "item_index", "detail"
    )


@query
def year_from_source(spark, folder):
    source = F.concat_ws("_", F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy"))
    return t.table(spark, folder, "orders").select(
        "o_orderkey", first_year(source).alias("first_year"), calendar_year(source).alias("calendar_year")
    )


@query
def union_sources(spark, folder):
    customer = t.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    supplier = t.table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation")
    )
    return catalog.union_sources([customer, supplier])


@query
def clean_long_data(spark, folder):
    return longform.clean_long_data(t.long_lineitem(spark, folder))


# --- headers -------------------------------------------------------------------
@query
def presence_matrix(spark, folder):
    return headers.presence_matrix(t.document_headers(spark, folder))


@query
def presence(spark, folder):
    return headers.presence(t.document_headers(spark, folder))


@query
def presence_count(spark, folder):
    return headers.presence_count(t.document_headers(spark, folder))


@query
def bitmap_presence(spark, folder):
    found = t.document_headers(spark, folder)
    return bitmaps.bitmap_presence_count(bitmaps.presence_bitmaps(found, bitmaps.numbered(found, "source")))


@query
def source_overlap(spark, folder):
    """Shared names of every language's sources with the first one."""
    found = t.table(spark, folder, "documents").select(F.col("lang").alias("source"), F.explode(F.split("text", " ")).alias("name"))
    found = found.where("source is not null")
    pairs = found.select(F.col("source").alias("source_b")).distinct().withColumn("source_a", F.lit("en"))
    return bitmaps.source_overlap(found, pairs.where("source_a <> source_b"))


@query
def keyword_containment(spark, folder):
    """In how many distinct texts every word of the benchmark occurs."""
    words = t.passages(spark, folder).select(F.explode(F.split("text", " ")).alias("keyword"))
    found = containment.containing_names(t.document_headers(spark, folder), words)
    return found.groupBy("keyword").agg(F.count("*").alias("n_names"))


@query
def explore_keyword(spark, folder):
    return headers.explore_keyword(t.document_headers(spark, folder), "eau")


@query
def candidate_headers(spark, folder):
    return headers.candidate_headers(t.document_headers(spark, folder), ["tion", "eau"], ["http"]).select(
        "source", "pos"
    )


@query
def keyword_hits(spark, folder):
    return headers.keyword_hits(t.document_headers(spark, folder), t.DOCUMENT_KEYWORDS)


@query
def keyword_sources(spark, folder):
    return headers.keyword_sources(t.document_headers(spark, folder), t.DOCUMENT_KEYWORDS)


@query
def header_fingerprint(spark, folder):
    return headers.header_types(t.order_headers(spark, folder))


@query
def header_fingerprint_members(spark, folder):
    return headers.header_type_members(t.order_headers(spark, folder))


@query
def rank_headers(spark, folder):
    return headers.rank_headers(t.amount_headers(spark, folder))


@query
def rank_headers_top(spark, folder):
    return headers.rank_headers(t.amount_headers(spark, folder), 20)


@query
def exclusivity_score(spark, folder):
    return headers.exclusivity_scores(t.document_headers(spark, folder), t.DOCUMENT_KEYWORDS).drop("name")


# --- profiles ------------------------------------------------------------------
@query
def source_metrics(spark, folder):
    return profile.source_metrics(t.document_headers(spark, folder))


@query
def source_summary(spark, folder):
    return profile.source_summary(profile.source_metrics(t.document_headers(spark, folder)))


LENGTH_SOURCES = ("documents", "orders", "part")


def _length_counts(spark, folder):
    sources = [t.table_source(spark, folder, name) for name in LENGTH_SOURCES]
    return profile.length_counts(catalog.headers(spark, sources), catalog.all_cells(sources))


@query
def length_bins(spark, folder):
    return profile.length_bins(_length_counts(spark, folder))


@query
def length_metrics(spark, folder):
    return profile.length_metrics(_length_counts(spark, folder))


@query
def length_summary(spark, folder):
    return profile.length_summary(profile.length_metrics(_length_counts(spark, folder)))


@query
def length_matrix(spark, folder):
    return profile.length_matrix(_length_counts(spark, folder), LENGTH_SOURCES)


@query
def source_matrix(spark, folder):
    return profile.source_matrix(_length_counts(spark, folder))


@query
def distribution_report(spark, folder):
    report = profile.distribution_report(_length_counts(spark, folder))
    maps = [F.to_json(c).alias(c) for c in ("header_len_distribution", "cell_len_distribution")]
    return report.select("source", *maps)


TYPE_SOURCES = ("part", "orders", "events", "customer")


def _type_counts(spark, folder):
    sources = [t.table_source(spark, folder, name) for name in TYPE_SOURCES]
    return profile.column_type_counts(catalog.all_cells(sources))


@query
def column_type_counts(spark, folder):
    return _type_counts(spark, folder)


@query
def source_sizes(spark, folder):
    sources = [t.table_source(spark, folder, name) for name in TYPE_SOURCES]
    return profile.source_sizes(catalog.headers(spark, sources), profile.column_type_counts(catalog.all_cells(sources)))


@query
def column_type_summary(spark, folder):
    return profile.column_type_summary(_type_counts(spark, folder))


# --- keys ----------------------------------------------------------------------
KEY_SOURCES = ("orders", "customer", "part", "supplier")


def _key_sources(spark, folder):
    return [t.table_source(spark, folder, name) for name in KEY_SOURCES]


@query
def key_diagnostics(spark, folder):
    return keys.key_diagnostics(_key_sources(spark, folder), t.TABLE_KEY_WORDS, t.TABLE_KEY_EXCLUSIONS)


@query
def key_diagnostics_full(spark, folder):
    return key_diagnostics(spark, folder)


@query
def key_diagnostics_sampled(spark, folder):
    """The sampled scan: the first rows of every source."""
    return keys.key_diagnostics(
        _key_sources(spark, folder), t.TABLE_KEY_WORDS, t.TABLE_KEY_EXCLUSIONS, sample_rows=fixed.SAMPLE_ROWS
    )


@query
def sketched_uniqueness(spark, folder):
    """Distinct values from sketches that were stored source by source, beside the exact count."""
    path = scratch_path(spark, "sketches")
    wanted = keys.contains_word(t.TABLE_KEY_WORDS)
    cells = [keys.candidate_cells([s], wanted) for s in _key_sources(spark, folder)]
    for some in cells:
        sketches.add_sketches(some, path)
    remove_at_end(spark, path)
    found = sketches.estimated_uniqueness(spark.read.parquet(path))
    exact = keys.column_uniqueness(catalog.union_sources(cells)).select("source", "pos", F.col("n_distinct").alias("exact"))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= sketches.ERROR * F.col("exact")
    return found.join(exact, ["source", "pos"]).select(
        "source", "name", "non_empty_count", F.col("exact").alias("n_distinct"), near.alias("within_error")
    )


def _map_keys(spark, folder, sample_rows):
    return keys.map_key_columns(
        _key_sources(spark, folder),
        trumps=("o_orderdate", "p_partkey"),
        keywords=("key", "name", "date"),
        bonus=("cust",),
        exclusions=("nation",),
        sample_rows=sample_rows,
    )


@query
def map_key_columns(spark, folder):
    return _map_keys(spark, folder, None)


@query
def map_key_columns_sampled(spark, folder):
    """The sampled scan: the first rows of every source."""
    return _map_keys(spark, folder, fixed.SAMPLE_ROWS)


@query
def map_key_columns_full(spark, folder):
    return _map_keys(spark, folder, None)


@query
def identify_metadata(spark, folder):
    sources = [t.orders_with_year(spark, folder)] + [
        t.table_source(spark, folder, name) for name in ("customer", "part")
    ]
    return keys.identify_metadata(sources, t.TABLE_TARGETS)


# --- separation ----------------------------------------------------------------
@query
def separate_main(spark, folder):
    return separate.separate_main(t.wide_lineitem(spark, folder))


@query
def separate_children(spark, folder):
    source = t.wide_lineitem(spark, folder)
    key_map = spark.createDataFrame([(source.name, "l_orderkey")], "source STRING, key_column STRING")
    return separate.separate([source], key_map)[1]


@query
def separate_children_by_block(spark, folder):
    return separate.separate_children(t.wide_lineitem(spark, folder), "l_orderkey", keep_block=True)


@query
def separate_many_files(spark, folder):
    """Child rows of many files that share a header, with each file's key column from the key map."""
    source = t.wide_lineitem(spark, folder)
    number = (F.col("c0").cast("long") / 500).cast("long")
    group = Source(source.name, source.frame.withColumn("source", F.concat(F.lit("f"), number)), source.header, (source.name,))
    named = group.frame.select("source").distinct().withColumn("key_column", F.lit("l_orderkey"))
    return separate.separate_groups([group], named)[1]


# --- corpus --------------------------------------------------------------------
@query
def build_documents(spark, folder):
    return corpus.build_documents(longform.clean_long_data(t.long_lineitem(spark, folder)))


@query
def build_document_parts(spark, folder):
    return corpus.build_document_parts(longform.clean_long_data(t.long_by_order_priority(spark, folder)), PART_BYTES)


@query
def tokenize_docs(spark, folder):
    return corpus.tokenize_docs(t.spread(t.documents(spark, folder)))


@query
def chunk_docs(spark, folder):
    return corpus.chunk_docs(corpus.tokenize_docs(t.spread(t.documents(spark, folder))), CHUNK_BYTES)


@query
def corpus_check(spark, folder):
    return corpus.corpus_check(t.documents(spark, folder))


@query
def doc_preview(spark, folder):
    return corpus.doc_preview(t.documents(spark, folder))


# --- retrieval -----------------------------------------------------------------
@query
def bm25_index(spark, folder):
    return index_documents(t.documents(spark, folder)).postings.drop("parent_id")


@query
def bm25_terms(spark, folder):
    return index_documents(t.documents(spark, folder)).terms


@query
def bm25_corpus(spark, folder):
    corpus_row = index_documents(t.documents(spark, folder)).corpus
    return corpus_row.select("n_docs", F.round("avg_dl", 6).alias("avg_dl"))


def _keyword_hits(spark, folder, max_bytes=fixed.CHUNK_BYTES):
    return search_documents(t.spread(t.documents(spark, folder)), t.passages(spark, folder), max_bytes=max_bytes)


@query
def bm25_search(spark, folder):
    return _keyword_hits(spark, folder).withColumn("score", F.round("score", 6))


@query
def bm25_search_chunked(spark, folder):
    return _keyword_hits(spark, folder, CHUNK_BYTES).withColumn("score", F.round("score", 6))


@query
def stored_search(spark, folder):
    """The same hits from an index that was saved and loaded."""
    path = scratch_path(spark, "keyword-index")
    index_documents(t.documents(spark, folder)).save(path)
    remove_at_end(spark, path)
    hits = bm25_search_in(KeywordIndex.load(spark, path), t.passages(spark, folder))
    return hits.withColumn("score", F.round("score", 6))


@query
def vector_store_check(spark, folder):
    return vectors.vector_store_check(t.vectors(spark, folder))


def _vector_hits(spark, folder):
    return vectors.knn_l2(t.vectors(spark, folder), t.passage_vectors(spark, folder))


@query
def knn_l2(spark, folder):
    return _vector_hits(spark, folder).withColumn("distance", F.round("distance", 6))


@query
def knn_l2_stored(spark, folder):
    """The same neighbours from stored blocks."""
    path = scratch_path(spark, "vector-blocks")
    vectorstore.save_blocks(t.vectors(spark, folder), path)
    remove_at_end(spark, path)
    found = vectorstore.knn_l2_stored(spark.read.parquet(path), t.passage_vectors(spark, folder))
    return found.withColumn("distance", F.round("distance", 6))


def _hybrid(spark, folder):
    return hybrid.hybrid_search(
        _keyword_hits(spark, folder),
        _vector_hits(spark, folder),
        t.documents(spark, folder),
        hybrid.few_hits(t.passages(spark, folder)),
    )


@query
def hybrid_search(spark, folder):
    return _hybrid(spark, folder)


@query
def answer_preview(spark, folder):
    return hybrid.answer_preview(_hybrid(spark, folder)).select("query_id", "position", "contents")


@query
def assemble_prompt(spark, folder):
    return hybrid.assemble_prompt(t.passages(spark, folder), _hybrid(spark, folder))


# --- files ---------------------------------------------------------------------
@query
def csv_round_trip(spark, folder):
    """A table written as CSV and read back as wide files."""
    path = scratch_path(spark, "csv")
    sinks.save_csv(t.text_table(t.table(spark, folder, "orders")), path)
    remove_at_end(spark, path)
    return longform.unpivot_sources(files.read_wide_groups(spark, path)).drop("source")


@query
def header_catalog(spark, folder):
    """Headers of very many small files, stored once each, with the number of files that have them."""
    path = scratch_path(spark, "many-files")
    for name, columns, rows in t.MANY_FILES:
        frame = t.table(spark, folder, name).select(columns).withColumn("file_no", F.floor(F.col(columns[0]) / rows))
        sinks.save_many_csv(frame, f"{path}/{name}", "file_no")
    remove_at_end(spark, path)
    found = headercatalog.header_catalog(spark, path)
    return found.columns.join(found.group_sizes(), "header_id").join(found.presence_count(), "name").select(
        "name", "pos", "n_files", "presence_count"
    )


@query
def split_records(spark, folder):
    """Texts with line breaks written as CSV and read back line by line."""
    path = scratch_path(spark, "records")
    docs = t.table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    sinks.save_csv(docs, path)
    remove_at_end(spark, path)
    return records.read_wide_split(spark, path).named()


@query
def long_round_trip(spark, folder):
    """Long rows written by source and read back as the clean table."""
    path = scratch_path(spark, "long-rows")
    sinks.save_long(t.long_lineitem(spark, folder), path)
    remove_at_end(spark, path)
    return longform.clean_long_data(files.read_long_parquet(spark, path))


@query
def document_round_trip(spark, folder):
    path = scratch_path(spark, "documents")
    sinks.save_documents(t.documents(spark, folder), path)
    remove_at_end(spark, path)
    return files.read_documents(spark, path)


# --- streaming -----------------------------------------------------------------
def _order_stream(spark, folder, transform=lambda long: long):
    schema = t.table(spark, folder, "orders").schema
    stream = stream_files(spark, folder, schema, "parquet", "orders.parquet")
    ids = ["o_orderkey", "o_custkey", "o_orderstatus"]
    rest = [c for c in schema.names if c not in ids]
    out, state = scratch_path(spark, "long"), scratch_path(spark, "stream")
    long = unpivot_stream(t.text_table(stream), ids, rest, out, state, transform)
    remove_at_end(spark, out)
    remove_at_end(spark, state)
    return long


@query
def stream_unpivot(spark, folder):
    return _order_stream(spark, folder)


@query
def stream_clean(spark, folder):
    """The clean table, parsed while it streams."""
    named = F.lit(t.ORDERS_FILE)
    return _order_stream(
        spark, folder, lambda long: longform.clean_long_data(long.withColumn("source", named), ["o_orderkey"])
    )


@query
def stream_changing_headers(spark, folder):
    """Files with their columns in two orders, unpivoted by one stream."""
    path, out, state = (scratch_path(spark, x) for x in ("changing", "long", "stream"))
    orders = t.text_table(t.table(spark, folder, "orders"))
    ids = ["o_orderkey", "o_custkey", "o_orderstatus"]
    rest = [c for c in orders.columns if c not in ids]
    even = F.col("o_orderkey").cast("long") % 2 == 0
    sinks.save_csv(orders.where(even).select(*ids, *rest), f"{path}/even")
    sinks.save_csv(orders.where(~even).select(*ids, *reversed(rest)), f"{path}/odd")
    remove_at_end(spark, path)
    long = unpivot_changing_stream(spark, path, out, state, len(ids))
    remove_at_end(spark, out)
    remove_at_end(spark, state)
    return long.drop("source")


@query
def incremental_long(spark, folder):
    """Files unpivoted in two runs; the second reads only what was added."""
    path, out = scratch_path(spark, "growing"), scratch_path(spark, "converted")
    orders = t.text_table(t.table(spark, folder, "orders"))
    ids = ["o_orderkey", "o_custkey", "o_orderstatus"]
    ordered = orders.select(*ids, *[c for c in orders.columns if c not in ids])
    for k in range(2):
        sinks.save_csv(ordered.where(F.col("o_orderkey").cast("long") % 2 == k), f"{path}/{k}")
        manifest.convert_changed(spark, path, out, id_width=len(ids))
    for used in (path, out, f"{out}.manifest"):
        remove_at_end(spark, used)
    return manifest.read_converted(spark, out).drop("source")
