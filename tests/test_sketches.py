"""Stored sketches against exact counts."""

from sheetlake.operators import keys, sketches

SCHEMA = "source string, pos int, name string, value string"


def cells(spark, first, last):
    """A key, a column of few values, an empty one; overlapping ranges share values."""
    rows = spark.range(first, last)
    parts = [
        rows.selectExpr("'f' || (id % 3) AS source", "0 AS pos", "'key' AS name", "CAST(id AS STRING) AS value"),
        rows.selectExpr("'f0' AS source", "1 AS pos", "'few' AS name", "CAST(id % 7 AS STRING) AS value"),
        rows.selectExpr("'f0' AS source", "2 AS pos", "'none' AS name", "CAST(NULL AS STRING) AS value"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def test_estimates_stay_within_their_error(spark, tmp_path):
    path = str(tmp_path / "s")
    sketches.add_sketches(cells(spark, 0, 20_000), path)
    sketches.add_sketches(cells(spark, 15_000, 40_000), path)
    found = {(x.source, x.name): x for x in sketches.estimated_uniqueness(spark.read.parquet(path)).collect()}
    both = cells(spark, 0, 20_000).unionByName(cells(spark, 15_000, 40_000))
    exact = {(x.source, x.name): x for x in keys.column_uniqueness(both).collect()}
    assert set(found) == set(exact) and len(found) == 5
    for key, x in found.items():
        assert x.non_empty_count == exact[key].non_empty_count
        assert abs(x.n_distinct - exact[key].n_distinct) <= sketches.ERROR * exact[key].n_distinct
        assert abs(x.uniqueness - exact[key].uniqueness) <= sketches.ERROR
    assert found["f0", "few"].n_distinct == 7 and found["f0", "none"].n_distinct == 0


def test_columns_united_over_their_sources(spark, tmp_path):
    path = str(tmp_path / "s")
    sketches.add_sketches(cells(spark, 0, 9_000), path)
    found = {x.name: x for x in sketches.estimated_uniqueness(spark.read.parquet(path), ("name",)).collect()}
    assert abs(found["key"].n_distinct - 9_000) <= 9_000 * sketches.ERROR


def test_only_sketches_are_read(spark, tmp_path):
    path = str(tmp_path / "s")
    sketches.add_sketches(cells(spark, 0, 50_000), path)
    assert spark.read.parquet(path).count() == 5
    assert sketches.estimated_uniqueness(spark.read.parquet(path).limit(0)).collect() == []
