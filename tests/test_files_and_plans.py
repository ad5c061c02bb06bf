import json

import pytest
from pyspark.sql import functions as F, types as T

from sheetlake.operators import longform, profile
from sheetlake.operators.longform import unpivot_source
from sheetlake.plans import etl, mapping
from sheetlake.plans.index import build_search_index
from sheetlake.session import scratch_path, shared_folder
from sheetlake.sources import files, sinks
from sheetlake.streaming.unpivot import stream_files, unpivot_stream

PREFIX = "支出先上位10者リスト"
HEADER_2014 = ["事業番号-1", "事業番号-2", "事業番号-3", "事業名", f"{PREFIX}-A.支払先-1-支出先", "備考", "備考"]
ROWS_2014 = [
    ["001", "02", "3", "橋, \"大\"", "甲", "x", "y"],
    ["002", "02", "3", "道", "", "NA", ""],
]
HEADER_2015 = ["事業番号-1", "事業番号-2", "事業名", "年度"]
ROWS_2015 = [["9", "8", "港", "2015"], ["10", "8", "空港", "2015"]]


def write_csv(path, header, rows, encoding):
    def line(cells):
        return ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ',"') else c for c in cells)

    path.write_bytes("\r\n".join(map(line, [header, *rows])).encode(encoding))


@pytest.fixture()
def folder(tmp_path):
    csv = tmp_path / "csv"
    csv.mkdir()
    write_csv(csv / "database2014.csv", HEADER_2014, ROWS_2014, "utf-8-sig")
    write_csv(csv / "database2015.csv", HEADER_2015, ROWS_2015, "cp932")
    (csv / "empty.csv").write_text("")
    (csv / "notes.txt").write_text("no source")
    return csv


def test_wide_files(spark, folder):
    sources = {s.name: s for s in files.read_wide_folder(spark, str(folder))}
    assert list(sources) == ["database2014.csv", "database2015.csv"]
    assert sources["database2014.csv"].header == tuple(HEADER_2014)
    assert sources["database2015.csv"].header == tuple(HEADER_2015)
    rows = [list(r)[1:] for r in sources["database2014.csv"].frame.orderBy("row_no").collect()]
    assert rows[0] == ROWS_2014[0]
    assert [list(r)[1:] for r in sources["database2015.csv"].frame.orderBy("row_no").collect()] == ROWS_2015
    assert files.detect_charset(spark, str(folder / "database2015.csv")) == "MS932"
    only = files.read_wide_folder(spark, str(folder), "*2015.csv")
    assert [s.name for s in only] == ["database2015.csv"]


def test_cells_with_line_breaks(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text('a,"b\nb",c\r\n1,"x\ny",3\r\n4,,6\r\n7,8,"9,9"\r\n', encoding="utf-8")
    source = files.read_wide_csv(spark, str(path))
    assert source.header == ("a", "b\nb", "c")
    rows = [list(r)[1:] for r in source.frame.orderBy("row_no").collect()]
    assert rows == [["1", "x\ny", "3"], ["4", None, "6"], ["7", "8", "9,9"]]
    cleaned = longform.clean_cells(source.frame).orderBy("row_no").collect()
    assert [r.c1 for r in cleaned] == ["x y", "", "8"]


def test_lines_that_are_no_records_are_refused(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('a,b\n"x\ny",7\n', encoding="utf-8")
    assert [list(r)[1:] for r in files.read_wide_csv(spark, str(path)).frame.collect()] == [["x\ny", "7"]]
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_wide_csv(spark, str(path), multi_line=False).frame.collect()


def test_charset_is_judged_by_all_lines(spark, tmp_path):
    write_csv(tmp_path / "ascii_head.csv", ["a", "b"], [["1", "港"]], "cp932")
    source = files.read_wide_folder(spark, str(tmp_path))[0]
    assert source.header == ("a", "b") and source.frame.head().c1 == "港"


def test_very_wide_files(spark, tmp_path):
    header = [f"n{i}" for i in range(20_500)]
    write_csv(tmp_path / "wide.csv", header, [["1"] * 20_500], "utf-8")
    source = files.read_wide_folder(spark, str(tmp_path))[0]
    assert len(source.header) == 20_500
    assert source.frame.select("c0", "c20499").head() == ("1", "1")
    assert len(files.read_header(spark, str(tmp_path / "wide.csv"))) == 20_500


def test_many_files_are_read_once_per_header(spark, tmp_path):
    for k in range(300):
        write_csv(tmp_path / f"f{2000 + k}.csv", ["k1", "k2", "k3", f"name{k % 3}"], [["1", "2", "3", str(k)]], "utf-8")
    groups = files.read_wide_groups(spark, str(tmp_path))
    assert len(groups) == 3 and sum(len(g.members) for g in groups) == 300
    long = longform.unpivot_sources(groups)
    assert long._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3
    rows = {(r.source, r.original_column_name, r.value) for r in long.collect()}
    assert rows == {(f"f{2000 + k}.csv", f"name{k % 3}", str(k)) for k in range(300)}
    assert files.read_headers(spark, str(tmp_path)).count() == 1200
    sinks.save_long(long, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("*/*.parquet"))) <= 330


def test_headers_and_sizes_of_files(spark, folder):
    heads = files.read_headers(spark, str(folder))
    assert [r.name for r in heads.filter("source = 'database2014.csv'").orderBy("pos").collect()] == HEADER_2014
    sizes = files.list_sources(spark, str(folder))
    metrics = profile.source_metrics(heads, sizes).collect()
    assert {(r.source, r.column_count) for r in metrics} == {("database2014.csv", 7), ("database2015.csv", 4)}


def test_load_clean_table(spark, folder, tmp_path):
    columns, count = etl.load_clean_table(spark, str(folder), str(tmp_path / "long"), "clean_long_data")
    assert [c for c, _ in columns][:3] == ["year", "business_id", "concept"] and count == 8
    rows = {(r.year, r.business_id, r.detail, r.value) for r in spark.table("clean_long_data").collect()}
    assert ("2014", "001-02-3", "支出先", "甲") in rows
    # The third column is an id column by place, but the id is made from names.
    assert ("2015", "9-8-", "年度", "2015") in rows
    direct = etl.clean_long_from_folder(spark, str(folder))
    assert {(r.year, r.business_id, r.detail, r.value) for r in direct.collect()} == rows
    sinks.replace_view(direct, "clean_view")
    assert spark.table("clean_view").count() == count


def test_index_from_clean_table(spark, folder, tmp_path):
    clean = etl.clean_long_from_folder(spark, str(folder))
    index = build_search_index(spark, clean, str(tmp_path / "search"))
    assert index.corpus.head().n_docs == 4
    before = files.read_documents(spark, str(tmp_path / "search" / "documents")).count()
    documents = tmp_path / "search" / "documents"
    kept = {p.name for p in documents.iterdir()}
    build_search_index(spark, clean, str(tmp_path / "search"))
    assert before == 4 and {p.name for p in documents.iterdir()} == kept
    build_search_index(spark, clean.filter("year = '2015'"), str(tmp_path / "search"))
    assert files.read_documents(spark, str(documents)).count() == 2
    (documents / "_SUCCESS").unlink()
    next(documents.glob("part-*")).unlink()
    build_search_index(spark, clean.filter("year = '2015'"), str(tmp_path / "search"))
    assert files.read_documents(spark, str(documents)).count() == 2


def test_one_record_with_most_rows_is_never_one_row(spark, tmp_path):
    rows = spark.range(4000).select(
        F.lit("2014").alias("year"), F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).alias("business_id"),
        F.lit("c").alias("concept"), F.lit("b").alias("block"), F.lit("1").alias("item_index"), F.lit("d").alias("detail"),
        F.concat(F.lit("v"), F.col("id")).alias("value"), F.lit("n").alias("original_column_name"),
    )
    index = build_search_index(spark, rows, str(tmp_path / "search"), max_bytes=500)
    docs = files.read_documents(spark, str(tmp_path / "search" / "documents"))
    assert docs.agg(F.max(F.octet_length("contents"))).head()[0] <= 520
    assert docs.filter("contents like '%v1。%' or contents like '%v3999%'").count() == 2
    numbers = sorted(int(r.id.rsplit("_", 1)[1]) for r in docs.filter("id like '%chunk%'").collect())
    assert numbers == list(range(len(numbers))) and len(numbers) > 50
    assert index.corpus.head().n_docs == docs.count()


def test_separate_folder(spark, folder, tmp_path):
    mapping.separate_folder(spark, str(folder), str(tmp_path / "out"), "database*.csv")
    keys = {r.source: r.key_column for r in files.read_key_rows(spark, str(tmp_path / "out" / "key_map")).collect()}
    assert keys == {"database2014.csv": "事業番号-1", "database2015.csv": "事業番号-1"}
    main = spark.read.option("header", True).csv(str(tmp_path / "out" / "main" / "database2014"))
    assert main.count() == 2 and not [c for c in main.columns if c.startswith(PREFIX)]
    children = spark.read.option("header", True).csv(str(tmp_path / "out" / "children"))
    assert [(r.project_id, r.supplier_name) for r in children.collect()] == [("001", "甲")]


def test_key_map_and_report_files(spark, tmp_path):
    path = tmp_path / "map.json"
    path.write_text(json.dumps({"a.csv": "事業番号", "b.csv": None}, ensure_ascii=False), encoding="utf-8")
    rows = {tuple(r) for r in files.read_key_map(spark, str(path)).collect()}
    assert rows == {("a.csv", "事業番号"), ("b.csv", None)}
    report = tmp_path / "report.json"
    report.write_text(json.dumps([{"filename": "a", "n": 1}, {"filename": "b", "n": 2}]), encoding="utf-8")
    assert {(r.filename, r.n) for r in files.read_report(spark, str(report)).collect()} == {("a", 1), ("b", 2)}


def test_reports_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([("名", 1, {"10": 2})], "source STRING, n INT, bins MAP<STRING, BIGINT>")
    sinks.save_report(frame, str(tmp_path / "report"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "report").glob("part-*"))
    assert json.loads(text) == {"source": "名", "n": 1, "bins": {"10": 2}}
    sinks.save_csv(frame.select("source", "n"), str(tmp_path / "csv"))
    again = files.read_inferred_csv(spark, str(tmp_path / "csv"))
    assert dict(again.dtypes)["n"] == "int"
    sinks.save_table(again, "header_matrix")
    assert sinks.describe_table(spark, "header_matrix") == ([("source", "string"), ("n", "int")], 1)


def test_long_files_unite_by_name(spark, tmp_path):
    folder = tmp_path / "long"
    folder.mkdir()
    spark.createDataFrame([("1", "c", "v")], "`事業番号-1` STRING, original_column_name STRING, value STRING").coalesce(1).write.parquet(str(folder / "a.parquet"))
    spark.createDataFrame([("c", "w")], "original_column_name STRING, value STRING").coalesce(1).write.parquet(str(folder / "b.parquet"))
    frame = files.read_long_parquet(spark, str(folder / "*.parquet"))
    assert {(r["事業番号-1"], r.value) for r in frame.collect()} == {("1", "v"), (None, "w")}
    write_csv(tmp_path / "l.csv", ["k", "original_column_name", "value"], [["1", "c", "007"]], "utf-8-sig")
    assert files.read_long_csv(spark, str(tmp_path / "l.csv"), "l").head().value == "007"


def test_stream_equals_batch_and_takes_only_new_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    header = ["a", "b", "c", "d"]
    write_csv(folder / "one.csv", header, [["1", "2", "3", "x"], ["4", "5", "6", " "]], "utf-8")
    batch = files.read_wide_csv(spark, str(folder / "one.csv"))
    schema = batch.named().schema
    out, state = scratch_path(spark, "long"), scratch_path(spark, "state")

    def run():
        return unpivot_stream(stream_files(spark, str(folder), schema), header[:3], header[3:], out, state)

    first = {tuple(r) for r in run().collect()}
    assert first == {tuple(r)[1:] for r in unpivot_source(batch).collect()} == {("1", "2", "3", "d", "x")}
    assert run().count() == 1
    write_csv(folder / "two.csv", header, [["7", "8", "9", "y"]], "utf-8")
    assert {tuple(r) for r in run().collect()} == first | {("7", "8", "9", "d", "y")}


def test_a_stream_refuses_another_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write_csv(folder / "one.csv", ["a", "b", "c", "d"], [["1", "2", "3", "x"]], "utf-8")
    write_csv(folder / "two.csv", ["a", "b", "d", "c"], [["1", "2", "x", "3"]], "utf-8")
    stream = stream_files(spark, str(folder), T.StructType.fromDDL("a STRING, b STRING, c STRING, d STRING"))
    with pytest.raises(Exception, match="STREAM_FAILED"):
        unpivot_stream(stream, ["a", "b", "c"], ["d"], str(tmp_path / "out"), str(tmp_path / "state"))


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_shared_folder_follows_the_session(spark):
    folder = shared_folder(spark)
    assert folder and shared_folder(spark) == folder
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
