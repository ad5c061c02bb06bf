from pyspark.sql import functions as F

from sheetlake.operators import longform, separate
from sheetlake.sources.catalog import Source, all_cells, cells, headers


def wide(spark, name="2014.csv"):
    names = ["事業番号-1", "事業番号-2", "事業番号-3", "事業名", "予算-グループ-金額-1"]
    rows = [
        ("001", "02", "3", "橋", " 5 "),
        ("002", None, "3", "　", "\t"),
        (None, None, None, "lost", "1"),
    ]
    return Source.of(name, spark.createDataFrame(rows, ", ".join(f"`{n}` STRING" for n in names)))


def test_unpivot_keeps_filled_cells_of_all_rows(spark):
    rows = {tuple(r) for r in longform.unpivot_source(wide(spark)).collect()}
    assert rows == {
        ("2014.csv", "001", "02", "3", "事業名", "橋"),
        ("2014.csv", "001", "02", "3", "予算-グループ-金額-1", " 5 "),
        ("2014.csv", None, None, None, "事業名", "lost"),
        ("2014.csv", None, None, None, "予算-グループ-金額-1", "1"),
    }


def test_unpivot_of_repeated_header_names(spark):
    source = Source.of("s", spark.createDataFrame([("1", "2", "3", "4", "5")], "a STRING, b STRING, c STRING, d STRING, e STRING"))
    source = Source(source.name, source.frame, ("a", "b", "c", "x", "x"))
    rows = sorted(tuple(r) for r in longform.unpivot_source(source).collect())
    assert rows == [("s", "1", "2", "3", "x", "4"), ("s", "1", "2", "3", "x", "5")]


def test_clean_long_data_with_a_missing_id_part(spark):
    first = longform.unpivot_source(wide(spark))
    short = Source.of("y2015", spark.createDataFrame([("9", "8", "計", "7")], "`事業番号-1` STRING, `事業番号-2` STRING, x STRING, `事業名` STRING"))
    long = longform.unpivot_sources([wide(spark), short])
    assert long.count() == first.count() + 1
    rows = {(r.year, r.business_id, r.item_index, r.detail, r.value) for r in longform.clean_long_data(long).collect()}
    assert rows == {
        ("2014", "001-02-3", None, "事業名", "橋"),
        ("2014", "001-02-3", "1", "金額", " 5 "),
        ("2015", "9-8-", None, "事業名", "7"),
        ("2014", "--", None, "事業名", "lost"),
        ("2014", "--", "1", "金額", "1"),
    }
    assert longform.clean_long_data(long).columns == list(longform.CLEAN_COLUMNS)


def test_unpivot_plan_has_no_shuffle(spark):
    plan = longform.clean_long_data(longform.unpivot_source(wide(spark)))._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_headers_and_cells(spark):
    source = wide(spark)
    assert headers(spark, [source]).filter("pos = 3").head().name == "事業名"
    every = cells(source)
    assert every.count() == 15
    assert every.filter((F.col("pos") == 1) & (F.col("value") == "")).count() == 2
    only = all_cells([source], lambda n: n == "事業名")
    assert {r.name for r in only.collect()} == {"事業名"} and {r.pos for r in only.collect()} == {3}


def test_count_of_long_rows_is_count_of_filled_cells(spark):
    source = Source.of("p", spark.range(50).selectExpr(
        "id AS a", "id + 1 AS b", "id AS c", "IF(id % 3 = 0, '', string(id)) AS d", "IF(id % 5 = 0, NULL, 'x') AS e"))
    expected = sum(i % 3 != 0 for i in range(50)) + sum(i % 5 != 0 for i in range(50))
    assert longform.unpivot_source(source).count() == expected


# --- separation ----------------------------------------------------------------
def expenditures(spark):
    prefix = "支出先上位10者リスト"
    names = [
        "key", f"{prefix}-A.支払先-1-支出先", f"{prefix}-A.支払先-1-支出額（百万円）", f"{prefix}-A.支払先-2-支出先",
        f"{prefix}-A.支払先-2-落札率", f"{prefix}-B.支払先-1-支出先", "備考",
    ]
    rows = [
        ("p1", "a", "10", "b", "99", None, "n"),
        ("p1", "c", None, " ", "99", "d", "n"),
        (" ", "e", "1", "f", "9", "g", "blank key"),
        ("NA", "e", "1", "f", "9", "g", "missing key"),
        ("p2", "NA", "", None, "5", "", "no children"),
    ]
    frame = spark.createDataFrame(rows, ", ".join(f"`{n}` STRING" for n in names))
    return Source.of("s.csv", frame)


def test_children_merge_blocks_and_take_the_last_filled(spark):
    rows = sorted(
        (r.project_id, r.expenditure_index, r.supplier_name, r.expenditure_amount_jpy_million, r.supplier_corporate_id)
        for r in separate.separate_children(expenditures(spark), "key").collect()
    )
    assert rows == [("p1", 1, "a", "10", None), ("p1", 1, "d", None, None), ("p1", 2, "b", None, None)]


def test_children_by_block(spark):
    rows = sorted(
        (r.block, r.expenditure_index, r.supplier_name)
        for r in separate.separate_children(expenditures(spark), "key", keep_block=True).collect()
    )
    assert rows == [("A", 1, "a"), ("A", 1, "c"), ("A", 2, "b"), ("B", 1, "d")]


def test_main_keeps_all_rows_and_drops_all_repeated_columns(spark):
    main = separate.separate_main(expenditures(spark))
    assert main.columns == ["key", "備考"] and main.count() == 5


def test_sources_without_key_are_skipped(spark):
    source = expenditures(spark)
    other = Source(source.name + "2", source.frame, source.header)
    key_map = spark.createDataFrame([("s.csv", "key"), ("s.csv2", None)], "source STRING, key_column STRING")
    mains, children = separate.separate([source, other], key_map)
    assert list(mains) == ["s.csv"] and children.count() == 3
    nothing = separate.separate([other], key_map)
    assert nothing == ({}, None)


def test_children_need_no_shuffle(spark):
    plan = separate.separate_children(expenditures(spark), "key")._jdf.queryExecution().toString()
    assert "Exchange" not in plan
