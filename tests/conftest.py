from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyboard.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Table from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def plan(capsys):
    """Text of a physical plan."""
    def text(df, mode="formatted"):
        capsys.readouterr()
        df.explain(mode)
        return capsys.readouterr().out
    return text


def rows(df, *order):
    """Rows as tuples, sorted, for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
