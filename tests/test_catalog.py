"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def test_every_query_has_sql():
    assert entry.catalog.QUERIES.keys() == entry.catalog.ORACLE.keys()
    assert entry.queries().keys() >= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_equals_sql(spark, db, name):
    got = entry.queries()[name](spark, SF)
    cur = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got.columns, got.collect()) == rows_of(names, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 10
