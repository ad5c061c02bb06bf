"""Very many small files: made without Hadoop's work per file, and read by few tasks."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sheetlake.sources import headercatalog, records, sinks

COLUMNS = "k string, `a,b` string, n long, d double, t timestamp"
ROWS = [
    ("x/y=1", "plain", 1, 0.5),
    ("x/y=1", 'say "yes", \\ no', None, None),
    ("x/y=1", "two\nlines", 3, 1e10),
    ("é 1", "  spaces ", 4, -0.0),
    ("é 1", "", 5, 2.0),
    (None, None, None, None),
    ("", "empty key", 6, 1.0),
    ('q"', "あ", 7, 1.0),
]


def made(path: Path) -> dict[str, list[str]]:
    """The folders below a path with the header and the sorted lines of their files."""
    found = {}
    for file in path.rglob("*.csv"):
        head, *rest = file.read_text(encoding="utf-8").split("\n")
        known = found.setdefault(str(file.parent.relative_to(path)), [head])
        assert known[0] == head and rest.pop() == ""
        known += rest
    return {k: [v[0], *sorted(v[1:])] for k, v in found.items()}


def test_files_equal_those_of_sparks_writer(spark, tmp_path):
    frame = spark.createDataFrame([(*x, None) for x in ROWS], COLUMNS).withColumn("t", F.timestamp_seconds("n"))
    frame.repartition(3, "k").write.partitionBy("k").option("header", True).csv(str(tmp_path / "spark"))
    sinks.save_many_csv(frame, str(tmp_path / "own"), "k")
    assert made(tmp_path / "own") == made(tmp_path / "spark")
    assert (tmp_path / "own/_SUCCESS").exists()
    with pytest.raises(FileExistsError):
        sinks.save_many_csv(frame, str(tmp_path / "own"), "k")


def test_tasks_write_the_files_themselves(spark, tmp_path):
    frame = spark.range(5000).select("id", F.lit("a").alias("b"), (F.col("id") % 40).alias("k"))
    sinks.save_many_csv(frame, str(tmp_path / "many"), "k")
    files = [x for x in (tmp_path / "many").rglob("*") if x.is_file() and "_SUCCESS" not in x.name]
    assert len(files) == 40 and {x.name for x in files} == {"part-00000.csv"}
    assert spark.read.option("header", True).csv(str(tmp_path / "many")).count() == 5000


def test_headers_of_many_files_are_read_by_few_tasks(spark, tmp_path):
    for k in range(120):
        (tmp_path / f"{k}.csv").write_text(f"a,b{k % 3}\n1,2\n")
    context, status = spark.sparkContext, spark.sparkContext.statusTracker()
    before = spark.conf.get(records.OPEN_COST)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    context.setJobGroup("many-read", "many-read")
    try:
        found = headercatalog.header_catalog(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        context.setLocalProperty("spark.jobGroup.id", None)
    stages = [x for j in status.getJobIdsForGroup("many-read") for x in status.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in map(status.getStageInfo, stages) if s) <= 4 * context.defaultParallelism < 120 / 4
    assert spark.conf.get(records.OPEN_COST) == before
    assert {tuple(x) for x in found.presence_count().collect()} == {("a", 120), ("b0", 40), ("b1", 40), ("b2", 40)}
