from collections import Counter

import pytest

from sheetlake.operators import headers as h, keys, profile
from sheetlake.operators.topn import first_n
from sheetlake.sources.catalog import Source, all_cells, headers
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def names(spark):
    files = {
        "a.csv": ["事業番号", "支出額", "支出額", "年度"],
        "b.csv": ["年度", "支出額", "支出額", "事業番号"],
        "c.csv": ["事業番号", "支出額", "支出額", "年度"],
        "d.csv": ["x", "支出先か。"],
    }
    rows = [(f, i, n) for f, ns in files.items() for i, n in enumerate(ns)]
    return spark.createDataFrame(rows, "source STRING, pos INT, name STRING").cache()


def test_presence(names):
    matrix = h.presence_matrix(names)
    assert matrix.columns == ["name", "a.csv", "b.csv", "c.csv", "d.csv"]
    rows = [tuple(r) for r in matrix.collect()]
    assert rows == sorted(rows)
    assert ("支出額", 1, 1, 1, 0) in rows and ("x", 0, 0, 0, 1) in rows
    counts = {r.name: r.presence_count for r in h.presence_count(names).collect()}
    assert counts == {r[0]: sum(r[1:]) for r in rows}
    assert {r.name: r.presence_count for r in h.matrix_row_sums(matrix).collect()} == counts


def test_presence_holds_for_any_number_of_sources(names):
    pairs = {(r.name, r.source) for r in h.presence(names).collect()}
    assert pairs == {(r.name, r.source) for r in names.collect()}


def test_explore_and_candidates(names):
    assert [r.name for r in h.explore_keyword(names).collect()] == ["支出先か。", "支出額"]
    assert {r.name for r in h.candidate_headers(names, ["支出", "年度"], ["か。"]).collect()} == {"支出額", "年度"}


def test_keyword_hits(names):
    hits = {(r.target, r.keyword): (r.total_occurrences, r.found_in_sources_count) for r in h.keyword_hits(names).collect()}
    assert hits == {
        ("project_id", "事業番号"): (3, 3),
        ("year", "年度"): (3, 3),
        ("expenditure_amount", "支出"): (7, 4),
        ("expenditure_amount", "支出額"): (6, 3),
    }
    files = {r.source for r in h.keyword_sources(names).filter("keyword = '支出額'").collect()}
    assert files == {"a.csv", "b.csv", "c.csv"}


def test_header_types(names):
    rows = {(r.type_no, r.column_count, r.total_length, r.n_sources, r.consistent) for r in h.header_types(names).collect()}
    assert rows == {(1, 2, 6, 1, True), (2, 4, 12, 3, False)}
    without_b = names.filter("source != 'b.csv'")
    assert {(r.type_no, r.consistent) for r in h.header_types(without_b).collect()} == {(1, True), (2, True)}
    members = {(r.type_no, r.source) for r in h.header_type_members(names).collect()}
    assert members == {(1, "d.csv"), (2, "a.csv"), (2, "b.csv"), (2, "c.csv")}


def test_rank_headers(names):
    rows = [tuple(r) for r in h.rank_headers(names).collect()]
    assert rows == [("支出額", 12.0, 3)]
    more = names.sparkSession.createDataFrame([("a", 0, "支出"), ("b", 0, "支出"), ("b", 1, "執行額")], names.schema)
    assert [tuple(r) for r in h.rank_headers(more).collect()] == [("執行額", 2.0, 1), ("支出", 0.2, 2)]
    assert h.rank_headers(more, 1).count() == 1


# --- profile ---------------------------------------------------------------------
@pytest.fixture(scope="module")
def sources(spark):
    lengths = [0, 1, 2, 10, 11, 5000, 5001]
    one = spark.createDataFrame([(i, "x" * n, str(i)) for i, n in enumerate(lengths)], "id INT, body STRING, `番号` STRING")
    two = spark.createDataFrame([("true", ""), ("false", None)], "flag STRING, nothing STRING")
    return [Source.of("one", one, one["id"]), Source.of("two", two)]


def test_lengths(spark, sources):
    counts = profile.length_counts(headers(spark, sources), all_cells(sources))
    bins = {(r.source, r.kind, r.bin): r.n for r in profile.length_bins(counts).collect()}
    assert bins[("one", "cell", "0")] == 1 and bins[("one", "cell", "5000+")] == 1
    assert bins[("one", "cell", "1")] == 15 and bins[("one", "cell", "10")] == 2
    assert bins[("two", "cell", "0")] == 2
    total = Counter()
    for (source, kind, _), n in bins.items():
        total[source, kind] += n
    assert total == {("one", "cell"): 21, ("one", "header"): 3, ("two", "cell"): 4, ("two", "header"): 2}
    metrics = {r.source: r for r in profile.length_metrics(counts).collect()}
    assert metrics["one"].max_cell_len == 5001
    assert metrics["one"].avg_cell_len == round((sum([0, 1, 2, 10, 11, 5000, 5001]) + 14) / 21, 1)
    assert metrics["two"].max_header_len == 7 and metrics["two"].cell_count == 4
    summary = profile.length_summary(profile.length_metrics(counts)).head()
    assert (summary.max_cell_len_overall, summary.max_header_len_overall) == (5001, 7)
    matrix = profile.length_matrix(counts, ["one", "two"]).collect()
    assert [r.bin for r in matrix] == ["0", "1", "10", "50", "5000", "5000+"]
    assert [(r.one, r.two) for r in matrix][:2] == [(1, 2), (15, 0)]
    turned = {r.source: r for r in profile.source_matrix(counts).collect()}
    assert turned["two"]["len_0"] == 2 and turned["one"]["len_5000+"] == 1
    report = profile.distribution_report(counts)
    assert report.filter("source = 'two'").head().cell_len_distribution == {"0": 2, "10": 2}
    assert "cell_len_distribution" not in profile.scalar_columns(report).columns


def test_column_types(spark, sources):
    counts = profile.column_type_counts(all_cells(sources))
    by_name = {r.name: r for r in counts.collect()}
    assert by_name["番号"].n_int == 7 and by_name["body"].n_empty == 1 and by_name["flag"].n_bool == 2
    rows = {(r.source, r.dominant_type): r for r in profile.column_type_summary(counts).collect()}
    assert rows[("one", "mostly_int")].column_count == 2
    assert rows[("two", "fully_empty")].avg_empty_rate == 1.0
    assert rows[("two", "fully_empty")].avg_non_empty_cell_len == 0.0
    assert rows[("one", "mostly_text")].avg_empty_rate == round(1 / 7, 3)


def test_source_metrics(spark, names):
    sizes = spark.createDataFrame([("a.csv", 3 * 1024 * 1024)], "source STRING, size_bytes BIGINT")
    metrics = profile.source_metrics(names, sizes)
    a = metrics.filter("source = 'a.csv'").head()
    assert (a.column_count, a.max_header_length, a.file_size_mb) == (4, 4, 3.0)
    summary = profile.source_summary(metrics).head()
    assert (summary.n_sources, summary.max_columns, summary.min_columns, summary.avg_columns) == (4, 4, 2, 3.5)
    assert summary.total_size_mb == 3.0


def test_sources_without_rows_have_a_size(spark):
    full = Source.of("full", spark.createDataFrame([("1", "2"), ("3", None)], "a STRING, b STRING"))
    bare = Source.of("bare", full.named().limit(0))
    counts = profile.column_type_counts(all_cells([full, bare]))
    found = {tuple(r) for r in profile.source_sizes(headers(spark, [full, bare]), counts).collect()}
    assert found == {("full", 2, 2), ("bare", 2, 0)}


# --- keys ------------------------------------------------------------------------
def frame(spark, columns):
    rows = list(zip(*columns.values()))
    return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`{n}` STRING" for n in columns))


def test_key_diagnostics(spark):
    source = Source.of("f", frame(spark, {
        "事業番号": ["b", "a", "b", "NA", "c"], "法人番号": list("12345"), "コード": [None] * 5, "名前": list("vwxyz"),
    }).coalesce(1))
    rows = [tuple(r) for r in keys.key_diagnostics([source]).collect()]
    assert rows == [("f", "事業番号", 0.75, 4, "b | a | c"), ("f", "コード", 0.0, 0, "")]
    many = Source.of("f", spark.range(900).select((F.col("id") % 300).cast("string").alias("事業番号")).coalesce(1))
    assert [tuple(r)[2:4] for r in keys.key_diagnostics([many]).collect()] == [(0.3333, 900)]
    two = [tuple(r) for r in keys.key_diagnostics([source], sample_rows=2).collect()]
    assert two[0] == ("f", "事業番号", 1.0, 2, "b | a")
    assert keys.key_diagnostics([source], keywords=["zz"]).count() == 0
    bare = Source.of("bare", frame(spark, {"事業番号": ["x"], "名前": ["y"]}).limit(0))
    assert [tuple(r) for r in keys.key_diagnostics([bare, source]).collect()][0] == ("bare", "事業番号", 0.0, 0, "")


def test_key_map(spark):
    same = ["k"] * 10
    unique = [str(i) for i in range(10)]
    sources = [
        Source.of("trump", frame(spark, {"x番号": unique, "事業番号": unique})),
        Source.of("second", frame(spark, {"事業番号": same, "事業番号-1": unique, "番号": unique})),
        Source.of("score", frame(spark, {"整理番号": unique, "事業の番号": unique, "法人番号": unique})),
        Source.of("tie", frame(spark, {"ID": unique, "番号": unique, "整理番号-9": unique})),
        Source.of("third", frame(spark, {"番号": ["a", "b", "c"] + ["c"] * 7})),
        Source.of("none", frame(spark, {"備考": unique, "番号": same})),
    ]
    found = {r.source: r.key_column for r in keys.map_key_columns(sources).collect()}
    assert found == {
        "trump": "事業番号", "second": "事業番号-1", "score": "事業の番号", "tie": "ID", "third": "番号", "none": None,
    }
    assert keys.map_key_columns([Source.of("n", frame(spark, {"備考": unique}))]).head().key_column is None


def test_trump_needs_more_than_the_minimum(spark):
    values = ["a", "b", "c"] + ["c"] * 7
    source = Source.of("s", frame(spark, {"事業番号-1": values, "番号": values}))
    # Uniqueness is exactly 0.3: no trump, and the plain name has the better score times uniqueness.
    assert keys.map_key_columns([source]).head().key_column == "事業番号-1"
    low = Source.of("s", frame(spark, {"事業番号": ["a"] * 10, "番号": values}))
    assert keys.map_key_columns([low]).head().key_column == "番号"


def test_identify_metadata(spark):
    unique = [str(i) for i in range(4)]
    source = Source.of("db2014.csv", frame(spark, {
        "事業番号の補足": ["a", "a", "b", ""], "事業番号": unique, "会計年度": ["2013"] * 4, "年度": ["2014", "2014", "　", "2013"],
        "当初予算の執行額の年度": unique, "執行額": ["", "", "", ""],
    }))
    other = Source.of("x", frame(spark, {"備考": unique}))
    rows = {(r.source, r.target): r for r in keys.identify_metadata([source, other]).collect()}
    assert set(rows) == {("db2014.csv", "project_id"), ("db2014.csv", "year"), ("x", None)}
    best = rows[("db2014.csv", "project_id")]
    assert (best.column_name, best.column_index, best.exclusivity_score, best.uniqueness_rate) == ("事業番号", 1, 1.0, 1.0)
    year = rows[("db2014.csv", "year")]
    assert (year.column_name, year.uniqueness_rate, year.non_empty_rate) == ("年度", 0.667, 0.75)


def test_first_n_is_exact_on_a_hot_group(spark):
    frame_ = spark.range(5000).selectExpr("IF(id % 3 = 0, 'hot', string(id % 50)) AS k", "id % 97 AS v", "id")
    got = {(r.k, r.rank, r.id) for r in first_n(frame_, ["k"], [F.asc("v"), F.asc("id")], 4, spread=8).collect()}
    groups = {}
    for r in frame_.collect():
        groups.setdefault(r.k, []).append((r.v, r.id))
    want = {(k, i, x[1]) for k, xs in groups.items() for i, x in enumerate(sorted(xs)[:4], start=1)}
    assert got == want
