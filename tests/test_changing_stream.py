"""One stream over files whose headers change."""

import csv

from sheetlake.streaming.changing import unpivot_changing_stream


def put(folder, name, rows):
    with open(folder / name, "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows(rows)


def run(spark, tmp_path, **options):
    found = unpivot_changing_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), 2, **options)
    columns = ["source", "id", "name", "original_column_name", "value"]
    return sorted(tuple(x) for x in found.select(columns).collect())


def test_swapped_and_added_columns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "y1.csv", [["id", "name", "a", "b"], ["1", "x", "1a", "1b"], ["2", "y", "", "two\nlines"]])
    put(tmp_path / "in", "y2.csv", [["id", "name", "b", "a", "new"], ["1", "x", "1b2", "1a2", "n"]])
    first = [
        ("y1.csv", "1", "x", "a", "1a"),
        ("y1.csv", "1", "x", "b", "1b"),
        ("y1.csv", "2", "y", "b", "two\nlines"),
        ("y2.csv", "1", "x", "a", "1a2"),
        ("y2.csv", "1", "x", "b", "1b2"),
        ("y2.csv", "1", "x", "new", "n"),
    ]
    assert run(spark, tmp_path) == first
    assert run(spark, tmp_path) == first
    put(tmp_path / "in", "y3.csv", [["id", "name", "c"], ["7", "z", "later"]])
    put(tmp_path / "in", "y4.csv", [["id", "name", "c"]])
    (tmp_path / "in" / "y5.csv").write_bytes(b"")
    assert run(spark, tmp_path) == [*first, ("y3.csv", "7", "z", "c", "later")]


def test_a_repeated_batch_replaces_what_it_left(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(5):
        put(tmp_path / "in", f"f{k}.csv", [["id", "name", f"c{k % 2}"], [str(k), "x", "v"]])
    want = [(f"f{k}.csv", str(k), "x", f"c{k % 2}", "v") for k in range(5)]
    assert run(spark, tmp_path, batch_files=2) == want
    # The last batch had written its rows when its commit was lost.
    commits = [x for x in (tmp_path / "state" / "commits").iterdir() if x.name.isdigit()]
    last = max(commits, key=lambda x: int(x.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert run(spark, tmp_path, batch_files=2) == want
