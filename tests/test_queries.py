"""Every registered query against DuckDB on the same tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(round(value, 6) + 0.0) if isinstance(value, float) else repr(value)


def rows(pdf):
    names = sorted(pdf.columns)
    return names, sorted(tuple(plain(v) for v in row) for row in pdf[names].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    ours = rows(QUERIES[name](spark, FOLDER).toPandas())
    theirs = rows(duck.execute(SQL[name]).fetchdf())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_word_vectors_cover_the_vocabulary(spark):
    words = {r["word"] for r in QUERIES["build_vocabulary"](spark, FOLDER).collect()}
    table = QUERIES["embedding_table"](spark, FOLDER).toPandas().set_index("ix")
    assert sorted(table.index) == list(range(len(words) + 1))
    filled = table["vec"].map(lambda v: len(v) == 300 and any(v) and all(map(math.isfinite, v)))
    assert not any(table.vec[0]) and filled.drop(0).all()
