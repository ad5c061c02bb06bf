"""Separation of many files in one go, against separation file by file."""

import csv

from pyspark.sql import functions as F

from sheetlake.operators import separate
from sheetlake.plans import mapping
from sheetlake.sources import files


def header(kind):
    plain = [["予算事業ID", "事業名", "other"], ["事業名", "other", "予算事業ID"], ["other", "事業番号", "事業名", "id"]][kind]
    return plain


def table(spark, tmp_path, n):
    """n files of three headers; the repeated columns are those of the given pattern."""
    from sheetlake.plans import tables as t

    names = t.wide_lineitem(spark, "/root/testdata/sf0.001").header
    repeated = [x for x in names if x not in ("l_orderkey", "n_lines")][:6]
    for k in range(n):
        head = header(k % 3) + repeated[: 3 + k % 3]
        rows = [[f"{k}-{r}-{c}" if c < 4 else str(100 * k + 10 * r + c) for c in range(len(head))] for r in range(2 + k % 2)]
        with open(tmp_path / f"database{k:03d}.csv", "w", newline="", encoding="utf-8") as out:
            csv.writer(out).writerows([head, *rows])


def test_equals_separation_file_by_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    table(spark, tmp_path / "in", 12)
    keys = spark.createDataFrame(
        [(f"database{k:03d}.csv", [["予算事業ID", "予算事業ID", "id"], ["事業名", "other", "missing"]][k % 2][k % 3]) for k in range(11)],
        "source string, key_column string",
    )
    single = files.read_wide_folder(spark, str(tmp_path / "in"))
    mains, children = separate.separate(single, keys)
    groups = files.read_wide_groups(spark, str(tmp_path / "in"))
    assert len(groups) == 3
    all_mains, all_children = separate.separate_groups(groups, keys)
    want = sorted(map(tuple, children.collect()), key=str)
    assert want and sorted(map(tuple, all_children.select(children.columns).collect()), key=str) == want
    assert {x.source for x in all_mains.select("source").distinct().collect()} == set(mains)
    for name, main in mains.items():
        got = all_mains.where(F.col("source") == name).select(main.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, main.collect()), key=str)


def test_the_plan_grows_with_headers_not_with_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    table(spark, tmp_path / "in", 60)
    groups = files.read_wide_groups(spark, str(tmp_path / "in"))
    keys = spark.createDataFrame([(f"database{k:03d}.csv", "事業名") for k in range(60)], "source string, key_column string")
    mains, children = separate.separate_groups(groups, keys)
    for frame in (mains, children):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 3
    assert mains.select("source").distinct().count() == 60
    assert {"事業番号", "予算事業ID", "other", "id", "source"} <= set(mains.columns)


def test_separate_many_writes_two_tables(spark, tmp_path):
    (tmp_path / "in").mkdir()
    table(spark, tmp_path / "in", 9)
    mapping.separate_many(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    mapping.separate_folder(spark, str(tmp_path / "in"), str(tmp_path / "single"))
    keys = {x.source: x.key_column for x in files.read_key_rows(spark, str(tmp_path / "out/key_map")).collect()}
    assert keys == {x.source: x.key_column for x in files.read_key_rows(spark, str(tmp_path / "single/key_map")).collect()}
    chosen = {k for k, v in keys.items() if v}
    assert chosen and {x.source for x in spark.read.parquet(str(tmp_path / "out/main")).select("source").distinct().collect()} == chosen
    single = spark.read.option("header", True).csv(str(tmp_path / "single/children"))
    assert spark.read.parquet(str(tmp_path / "out/children")).count() == single.count() > 0


def test_no_groups(spark):
    keys = spark.createDataFrame([], "source string, key_column string")
    assert separate.separate_groups([], keys) == (None, None)
