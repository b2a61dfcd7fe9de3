"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyboard.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS

# What separates words: space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A top-level column, whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(stem: str) -> str:
    """A column name that no table of a user has."""
    return f"__{stem}_{uuid.uuid4().hex[:8]}"


def word_count(text: Column) -> Column:
    """Number of blank-separated words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def broadcast_measured(df: DataFrame, row_bytes: int) -> DataFrame:
    """A broadcast hint if rows times a known row width are within the library's bound.

    Beyond it the join stays a shuffle join, whose skewed partitions are split at run time.
    """
    rows = df.count()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and rows * row_bytes <= BROADCAST_BYTES else df
