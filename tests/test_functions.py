"""Column functions, value by value; expected values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from sheetlake.functions import cells, fixed, scoring, text, tokens
from sheetlake.functions.headerpath import with_header_path


def one_column(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "name, concept, block, index, detail",
    [
        ("支出先上位10者リスト-A.支払先-1-支出額（百万円）", "支出先上位10者リスト", "A.支払先", "1", "支出額（百万円）"),
        ("支出先上位10者リスト-A.支払先-1-契約-方式", "支出先上位10者リスト", "A.支払先", "1", "契約-方式"),
        ("支出先上位10者リスト-A.支払先-1", "支出先上位10者リスト", "A.支払先", "1", ""),
        ("支出先上位10者リスト-A.支払先-x-金額", "支出先上位10者リスト", "A.支払先", None,
         "支出先上位10者リスト-A.支払先-x-金額"),
        ("予算-グループ-金額-3", "予算", "グループ", "3", "金額"),
        ("予算-グループ-金額", "予算", "グループ", None, "予算-グループ-金額"),
        ("事業名", "事業名", None, None, "事業名"),
        ("予算-グループ-金額-３", "予算", "グループ", None, "予算-グループ-金額-３"),
        ("", "", None, None, ""),
    ],
)
def test_header_path(spark, name, concept, block, index, detail):
    frame = with_header_path(spark.createDataFrame([(name,)], "original_column_name STRING"))
    row = frame.head()
    assert (row.concept, row.block, row.item_index, row.detail) == (concept, block, index, detail)


def test_cell_types(spark):
    expected = {
        "empty": ["", "   ", "\t", "　"],
        "bool": ["true", "FALSE", "True"],
        "int": ["0", "007", "+5", "-3", " 5 ", "1_000", "５"],
        "float": ["5.0", ".5", "5.", "1e5", "nan", "inf", "-Infinity", "1_0.5"],
        "text": ["1,000", "5d", "１２円", "--1", "_1", "abc", "1__0", "true ", ".", "0x10", "1 2"],
    }
    values = [v for vs in expected.values() for v in vs]
    labels = [k for k, vs in expected.items() for _ in vs]
    assert one_column(spark, values, cells.cell_type) == labels


def test_dominant_type(spark):
    rows = [
        ((0, 0, 0, 0, 0, 0), "empty_column"),
        ((10, 10, 0, 0, 0, 0), "fully_empty"),
        ((100, 95, 5, 0, 0, 0), "mostly_empty"),
        ((100, 50, 48, 2, 0, 0), "mostly_int"),
        ((100, 0, 5, 95, 0, 0), "mostly_float"),
        ((100, 0, 6, 94, 0, 0), "mixed"),
        ((10, 0, 0, 0, 10, 0), "mostly_bool"),
        ((10, 9, 0, 0, 0, 1), "mostly_text"),
    ]
    frame = spark.createDataFrame(
        [(i, *r) for i, (r, _) in enumerate(rows)], "i INT, n INT, e INT, a INT, f INT, b INT, t INT"
    )
    label = cells.dominant_type(*[F.col(c) for c in ("n", "e", "a", "f", "b", "t")])
    assert [r[0] for r in frame.orderBy("i").select(label).collect()] == [label for _, label in rows]


def test_length_bins(spark):
    lengths = [0, 1, 2, 10, 11, 50, 51, 1000, 1001, 5000, 5001]
    labels = one_column(spark, lengths, lambda c: cells.bin_label(cells.bin_number(c)), "INT")
    assert labels == ["0", "1", "10", "10", "50", "50", "100", "1000", "5000", "5000", "5000+"]


def test_blank_strip_and_clean(spark):
    values = [None, "", "　\t", " a ", "　b", "a\nb\r\nc", " nb", "\x1f"]
    assert one_column(spark, values, text.is_filled) == [False, False, False, True, True, True, True, False]
    assert one_column(spark, values, text.strip) == [None, "", "", "a", "b", "a\nb\r\nc", "nb", ""]
    assert one_column(spark, values, text.clean_cell)[5] == "a b  c"
    assert one_column(spark, [None], text.clean_cell) == [""]


def test_years(spark):
    values = ["database2014.csv", "1998_2003", "x", "12a20195"]
    assert one_column(spark, values, text.first_year) == ["2014", "1998", "", "2019"]
    assert one_column(spark, values, text.calendar_year) == [2014, 2003, None, 2019]


def test_names_previews_and_digits(spark):
    assert one_column(spark, ["a b-ー1!"], text.sheet_safe_name) == ["a_b_ー1_"]
    assert one_column(spark, ["--a  b__c!"], text.file_safe_name) == ["a_b__c"]
    assert one_column(spark, ["abcdef", "ab"], lambda c: text.preview(c, 3)) == ["abc...", "ab..."]
    assert one_column(spark, ["d_chunk_3", "d", "a_chunk_1_chunk_2"], text.parent_id) == ["d", "d", "a"]
    assert one_column(spark, ["１2", "07"], text.digits_to_int) == [12, 7]
    assert one_column(spark, ["NA", "na", "", "x"], text.drop_na_tokens) == [None, "na", None, "x"]


def test_words(spark):
    values = ["Où est-ce? 日本のABC12", "", "é"]
    assert one_column(spark, values, tokens.words) == [
        ["Où", "est", "ce", "日", "本", "の", "ABC12"], [], ["é"],
    ]
    assert one_column(spark, ["a  b", ""], tokens.spaced) == [["a", "b"], []]


def test_exclusivity(spark):
    names = ["事業番号", "事業番号と年度", "年度の執行額と事業名", "備考"]
    score = lambda t: one_column(spark, names, lambda c: scoring.exclusivity(c, t, fixed.METADATA_TARGETS))
    assert score("project_id") == [1.0, 0.5, 0.0, 0.0]
    assert score("year") == [0.0, 0.5, 0.0, 0.0]


def test_amount_score(spark):
    names = {
        "執行額": 20,
        "支出済額と支出額": 40,
        "支出先": 1,
        "備考": None,
        "支出額の評価": 5,
        "支出額は妥当か。": 5,
        "支出額は妥当か": 5,
        "予算-支出額": 25,
        "支出額-備考": 20,
        "執行額の評価の説明": -10,
    }
    assert one_column(spark, list(names), scoring.amount_tenths) == list(names.values())


def test_key_name_score(spark):
    names = {
        "事業番号": 196.0,
        "事業番号-1": 144.0,
        "整理番号": 96.0,
        "法人番号": None,
        "ID": 98.0,
        "備考": None,
    }
    assert one_column(spark, list(names), scoring.key_name_score) == list(names.values())
