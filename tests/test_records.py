"""Header catalogues and split records against the whole-file reader and Python's csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from sheetlake.operators import headers, ordered
from sheetlake.sources import files, headercatalog, records, sinks


def write(path, rows, charset="utf-8", end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    path.write_bytes(out.getvalue().encode(charset))


def test_catalog_stores_each_header_once(spark, tmp_path):
    kinds = [["id", "a,b", 'say "x"'], ["id", "二行", "line\nbreak"], ["﻿id", "", "a", "a"]]
    for k in range(60):
        write(tmp_path / f"f{k:03d}.csv", [kinds[k % 3], ["1", "é", "x", "y"][: len(kinds[k % 3])]], end="\r\n" if k % 2 else "\n")
    write(tmp_path / "old.csv", [["番号", "名"], ["1", "あ"]], "cp932")
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "other.txt").write_bytes(b"no,header\n")
    found = headercatalog.header_catalog(spark, str(tmp_path))
    assert found.files.count() == 61 and found.group_sizes().count() == 4
    assert {x.source: x.charset for x in found.files.collect()}["old.csv"] == "MS932"
    names = {}
    for x in found.headers().orderBy("source", "pos").collect():
        names.setdefault(x.source, []).append(x.name)
    want = [["id", "a,b", 'say "x"'], ["id", "二行", "line\nbreak"], ["id", "", "a", "a"]]
    assert all(names[f"f{k:03d}.csv"] == want[k % 3] for k in range(60)) and names["old.csv"] == ["番号", "名"]
    counts = {tuple(x) for x in found.presence_count().collect()}
    assert counts == {tuple(x) for x in headers.presence_count(found.headers()).collect()}
    assert ("id", 60) in counts and ("a", 20) in counts


def test_catalog_plan_makes_no_rows_on_the_driver(spark, tmp_path):
    write(tmp_path / "a.csv", [["id", "x"], ["1", "2"]])
    found = headercatalog.header_catalog(spark, str(tmp_path))
    assert "LocalTableScan" not in found.headers()._jdf.queryExecution().executedPlan().toString()


def table(seed, n):
    pick = random.Random(seed)
    parts = ["a", ",", '"', "\n", "\r\n", "é", " ", "二", "x" * 40]
    return [["id", 'b"c', "d"]] + [
        [str(k), "".join(pick.choices(parts, k=pick.randint(0, 9))), pick.choice(["", "plain", "two\nlines"])] for k in range(n)
    ]


@pytest.mark.parametrize("charset", ["utf-8", "cp932"])
def test_a_split_file_equals_the_whole_read(spark, tmp_path, charset):
    rows = [[x.replace("é", "あ") for x in row] for row in table(1, 800)] if charset == "cp932" else table(1, 800)
    path = tmp_path / "big.csv"
    write(path, rows, charset)
    key, small = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = files.read_wide_csv(spark, str(path))
    want = sorted(map(tuple, whole.frame.drop("row_no").collect()), key=str)
    try:
        spark.conf.set(key, "2000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert records.lines_of(spark, str(path)).rdd.getNumPartitions() > 5
        found = records.read_wide_split(spark, str(path))
        got = found.frame.orderBy("row_no").collect()
    finally:
        spark.conf.set(key, small)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found.header == whole.header == ("id", 'b"c', "d")
    assert [x.c0 for x in got] == [x[0] for x in rows[1:]] and [x.row_no for x in got] == list(range(800))
    assert sorted((tuple(x)[1:] for x in got), key=str) == want


def test_a_file_without_rows(spark, tmp_path):
    write(tmp_path / "h.csv", [["a", "b"]])
    (tmp_path / "none.csv").write_bytes(b"")
    assert records.read_wide_split(spark, str(tmp_path / "h.csv")).frame.count() == 0
    assert records.read_wide_split(spark, str(tmp_path / "none.csv")) is None


def test_quotes_are_counted_by_byte(spark):
    lines = [b'a"b""', b"", "あ\"".encode("cp932"), b"\x82\x22", b'""""']
    frame = spark.createDataFrame([(x,) for x in lines], "line binary")
    found = [int(x[0]) for x in frame.select(records.quotes_in(F.col("line"))).collect()]
    assert found == [x.count(b'"') for x in lines]


def test_many_files_are_made_and_listed_by_a_bounded_number_of_tasks(spark, tmp_path):
    most = spark.conf.get(records.LISTING)
    context, status = spark.sparkContext, spark.sparkContext.statusTracker()

    def tasks(group, step):
        context.setJobGroup(group, group)
        step()
        context.setLocalProperty("spark.jobGroup.id", None)
        jobs = [status.getJobInfo(j) for j in status.getJobIdsForGroup(group)]
        return [status.getStageInfo(x).numTasks for job in jobs for x in job.stageIds]

    frame = spark.range(900).select("id", (F.col("id") % 90).alias("k"))
    wrote = tasks("many-written", lambda: sinks.save_many_csv(frame, str(tmp_path / "many"), "k"))
    assert max(wrote) == 4 * context.defaultParallelism
    listed = tasks("many-listed", lambda: records.lines_of(spark, str(tmp_path)))
    assert listed and max(listed) <= 4 * context.defaultParallelism < 90
    assert spark.conf.get(records.LISTING) == most
    found = headercatalog.header_catalog(spark, str(tmp_path))
    assert found.files.count() == 90 and {tuple(x) for x in found.presence_count().collect()} == {("id", 90)}
    assert records.lines_of(spark, str(tmp_path)).count() == 990


def test_lines_are_laid_out_once(spark, tmp_path, monkeypatch):
    write(tmp_path / "a.csv", table(2, 300))
    labels = []

    def kept(frame, label, written=ordered.written):
        labels.append(label)
        return written(frame, label)

    monkeypatch.setattr(ordered, "written", kept)
    found = records.records_of(records.lines_of(spark, str(tmp_path)))
    assert sorted(x.record_no for x in found.collect()) == list(range(1, 302)) and labels == ["slices"]
