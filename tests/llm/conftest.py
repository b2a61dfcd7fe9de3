"""Comparison of a registered query with its SQL."""

import os

import duckdb
import pytest

from tallyboard.llm import queries
from tools.check import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture
def equals_sql(spark):
    def check(name, sf=SF):
        con = duckdb.connect()
        for f in os.listdir(sf):
            con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
        got = queries.QUERIES[name](spark, sf)
        want = con.execute(queries.ORACLE[name])
        names = [d[0] for d in want.description]
        assert sorted(got.columns) == sorted(names)
        assert rows_of(got.columns, got.collect()) == rows_of(names, want.fetchall())
    return check
