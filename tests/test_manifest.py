"""Only new and changed files are converted."""

import os

import pytest

from sheetlake.sources import manifest


def put(folder, name, rows, when):
    path = folder / name
    path.write_text("".join(",".join(r) + "\n" for r in rows), encoding="utf-8")
    os.utime(path, (when, when))


def names(paths):
    return [x.rsplit("/", 1)[-1] for x in paths]


def rows(spark, out):
    found = manifest.read_converted(spark, out).select("source", "id", "original_column_name", "value")
    return sorted(map(tuple, found.collect()))


def files_in(out):
    return {(p, os.path.getmtime(p)) for d, _, xs in os.walk(out) for x in xs if x.endswith(".parquet") for p in [os.path.join(d, x)]}


def test_a_second_run_reads_no_file_and_a_changed_one_is_redone(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out = str(tmp_path / "out")
    put(tmp_path / "in", "a.csv", [["id", "x"], ["1", "a1"]], 1000)
    put(tmp_path / "in", "b.csv", [["id", "y", "x"], ["2", "b1", "b2"]], 1000)
    run = lambda: names(manifest.convert_changed(spark, str(tmp_path / "in"), out, id_width=1))
    assert run() == ["a.csv", "b.csv"]
    want = [("a.csv", "1", "x", "a1"), ("b.csv", "2", "x", "b2"), ("b.csv", "2", "y", "b1")]
    assert rows(spark, out) == want
    before = files_in(out)
    assert run() == [] and files_in(out) == before and rows(spark, out) == want

    put(tmp_path / "in", "b.csv", [["id", "y", "x"], ["2", "b9", "b2"]], 2000)
    put(tmp_path / "in", "c.csv", [["id", "z"], ["3", "c1"]], 1000)
    kept = {x for x in before if "source=a.csv" in x[0]}
    assert run() == ["b.csv", "c.csv"] and kept <= files_in(out)
    want = [("a.csv", "1", "x", "a1"), ("b.csv", "2", "x", "b2"), ("b.csv", "2", "y", "b9"), ("c.csv", "3", "z", "c1")]
    assert rows(spark, out) == want

    (tmp_path / "in" / "a.csv").unlink()
    assert run() == [] and rows(spark, out) == want[1:]
    put(tmp_path / "in", "a.csv", [["id", "x"], ["1", "again"]], 3000)
    assert run() == ["a.csv"] and rows(spark, out) == [("a.csv", "1", "x", "again"), *want[1:]]


def test_a_run_that_failed_is_done_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out = str(tmp_path / "out")
    put(tmp_path / "in", "a.csv", [["id", "x"], ["1", "a1"]], 1000)

    def broken(spark, paths):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        manifest.convert_changed(spark, str(tmp_path / "in"), out, convert=broken)
    # A manifest without its mark is none.
    (tmp_path / "out.manifest" / "version=7").mkdir(parents=True)
    assert names(manifest.convert_changed(spark, str(tmp_path / "in"), out, id_width=1)) == ["a.csv"]
    assert rows(spark, out) == [("a.csv", "1", "x", "a1")]


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "empty.csv", [], 1000)
    assert manifest.convert_changed(spark, str(tmp_path / "in"), str(tmp_path / "out")) == []
    put(tmp_path / "in", "a.csv", [["id", "b", "c", "d"]], 1000)
    assert names(manifest.convert_changed(spark, str(tmp_path / "in"), str(tmp_path / "out"))) == ["a.csv"]
    assert manifest.convert_changed(spark, str(tmp_path / "in"), str(tmp_path / "out")) == []
