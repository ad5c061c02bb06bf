"""Every registered query against its SQL twin, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from sheetlake.plans.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    number = float(value)
    return round(number, 9) if math.isfinite(number) else str(number)


def test_every_query_has_a_twin():
    assert set(all_queries()) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).columns == ["id", "contents"]


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = contract.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    cursor = duck.execute(contract.oracle_sql()[name])
    places = {d[0]: i for i, d in enumerate(cursor.description)}
    assert sorted(places) == columns
    theirs = sorted((tuple(plain(r[places[c]]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert len(ours) > 0 and ours == theirs
