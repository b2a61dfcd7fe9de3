"""Append to a relational table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tallyboard.operators.joins import missing_keys


class DatabaseWriteError(RuntimeError):
    """Rows could not be written to the database."""


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
                connections: int = 8, batch_rows: int = 10_000) -> None:
    """Append all rows. There is no key: a second run appends them again, see ``new_rows``.

    ``connections`` bounds the tasks that write at once. Each task commits its
    rows in one transaction, so a task that is lost before its commit leaves
    nothing behind.
    """
    writer = df.write.option("numPartitions", connections).option("batchsize", batch_rows)
    try:
        writer.jdbc(url, table, mode="append", properties=dict(properties or {}))
    except Exception as e:
        raise DatabaseWriteError(f"cannot append to {table}: {e}") from e


def existing_keys(batch: DataFrame, url: str, table: str, keys: Sequence[str], split_by: str,
                  properties: Mapping[str, str] | None = None, connections: int = 8) -> DataFrame:
    """Keys the table already holds within the batch's range of ``split_by``.

    Only the key columns of that range leave the database, over several
    connections. ``split_by`` is one of the keys, a date, timestamp or number;
    stored rows without it count if the batch has such rows. The batch is read
    here once, so hand over one that is cheap to read again.
    """
    low, high, bare = batch.agg(F.min(split_by), F.max(split_by), F.count_if(F.col(split_by).isNull())).first()
    reader = batch.sparkSession.read
    if low is not None and low != high:
        reader = (reader.option("partitionColumn", split_by).option("numPartitions", connections)
                  .option("lowerBound", str(low)).option("upperBound", str(high)))
    stored = reader.jdbc(url, table, properties=dict(properties or {}))
    wanted = F.col(split_by).between(low, high)
    if bare:
        wanted = wanted | F.col(split_by).isNull()
    return stored.where(wanted).select(*keys)


def new_rows(df: DataFrame, existing: DataFrame,
             keys: Sequence[str] = ("season", "snapshot_date", "Player", "Tm")) -> DataFrame:
    """Rows whose key the target table does not hold yet: makes an append safe to repeat."""
    return missing_keys(df, existing, keys, keys)
