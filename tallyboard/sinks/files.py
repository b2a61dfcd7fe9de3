"""Parquet and CSV writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyboard.operators.joins import broadcast_if_small, key_join
from tallyboard.session import scratch_table
from tallyboard.sinks.relational import new_rows
from tallyboard.sources.ranks import CSV


def write_table(df: DataFrame, path: str) -> None:
    """Replace a whole table. Write errors surface."""
    df.write.mode("overwrite").parquet(path)


def _gathered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    # Without this every task would write a small file into every partition. A
    # partition that holds much of the data is split over many tasks at run time.
    return df.hint("rebalance", *[F.col(c) for c in by])


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str], gather: bool = True) -> None:
    """Replace just the partitions present in ``df``; a re-run of one day or season changes no other.

    ``gather=False`` saves the shuffle when all rows go to one partition anyway.
    """
    df = _gathered(df, by) if gather else df
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def land(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write a whole table laid out by partition columns."""
    _gathered(df, by).write.mode("overwrite").partitionBy(*by).parquet(path)


def append_table(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Append all rows, laid out by partition columns if any. There is no key: a second run appends them again."""
    writer = df.write.mode("append")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def append_new(df: DataFrame, path: str, keys: Sequence[str], by: Sequence[str] = ()) -> None:
    """Append only the rows whose key the table does not hold yet, so a second run adds nothing.

    ``by`` are the table's partition columns, if they are among the keys: then only
    the partitions that the batch touches are read. The batch is evaluated once, and
    the new rows are written aside first: they are found by reading the table that is
    about to change.
    """
    batch = scratch_table(df, "batch")
    held = df.sparkSession.read.parquet(path)
    if by:
        touched = broadcast_if_small(batch.select(*by).distinct())
        held = key_join(held, touched, by, by, "left_semi")
    append_table(scratch_table(new_rows(batch, held, keys), "new_rows"), path, by)


def _write_csv(df: DataFrame, path: str, by: Sequence[str]) -> None:
    df = df.repartition(*by) if by else df.coalesce(1)
    writer = df.write.mode("overwrite").options(**CSV)
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_rank_csv(wide: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Wide rank table with its positions, one file per run. A run is a top-n table that one task writes."""
    _write_csv(wide, path, by)


def write_report_csv(report: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Final report, separator ``,`` and decimal point, one file per run. A run is a top-n table that one task writes."""
    _write_csv(report, path, by)
