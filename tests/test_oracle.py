"""Every query against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from tests.conftest import TESTDATA

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{TESTDATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    ours = QUERIES[name](spark, TESTDATA)
    columns = sorted(ours.columns)
    rows = [tuple(row) for row in ours.select(*columns).collect()]
    theirs = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert len(rows) > 0
    assert _sorted(rows) == _sorted(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, TESTDATA).count() > 0


def test_entry(spark):
    top = entry_module.entry(spark)
    assert top.columns == ["category", "rank", "term", "chi2"]
    assert top.groupBy("category").count().filter("count > 75").count() == 0
