"""Every query with SQL gives the same rows as DuckDB over the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("SKYSIFT_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def canon(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(None if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v) for v in row) for row in frame.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, duck, name):
    got, want = entry.queries()[name](spark, FOLDER).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n not in entry.oracle_sql() and not n.startswith("op") and n != "pipeline"))
def test_has_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
