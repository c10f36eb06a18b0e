"""Every registered query with SQL agrees with DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    result = db.sql(SQL[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(result.fetchall(), result.columns)


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_operator_is_covered():
    from tallyforge.catalog import QUERIES

    covered = {c for q in QUERIES.values() for c in q.covers.split()}
    wanted = {f"{g}{i}" for g, n in dict(S=8, P=25, E=15, A=20, W=14, J=7, T=6, M=30).items() for i in range(1, n + 1)}
    assert wanted - covered == set()
