"""Appends that are safe to repeat: a ledger says which batches a table holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyboard.session import scratch_table
from tallyboard.sinks.relational import append_jdbc, new_rows

LEDGER = "batch_id string, n_rows bigint"


class BatchChangedError(ValueError):
    """A batch that was applied before comes again with another number of rows."""


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def applied_batches(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, n_rows) of the batches that count, one file each."""
    folder = f"{path}/ledger"
    return spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(folder) if _exists(spark, folder) \
        else spark.createDataFrame([], LEDGER)


def append_batch(df: DataFrame, path: str, batch_id: str) -> bool:
    """Append the rows of a batch to a Parquet table, once; False if the table held the batch.

    Rows go to a partition of their own and count from the moment the ledger names the batch.
    A run that dies before that leaves rows that nobody reads; the next run replaces them. A
    batch is known by its name: one that comes again with another number of rows raises.
    """
    spark = df.sparkSession
    held = applied_batches(spark, path).where(F.col("batch_id") == batch_id).first()
    if held is not None:
        n = df.count()
        if n != held["n_rows"]:
            raise BatchChangedError(f"batch {batch_id} was applied with {held['n_rows']} rows and now has {n}")
        return False
    rows = f"{path}/rows/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(rows)
    n = spark.read.schema(df.schema).parquet(rows).count()  # from the footers
    spark.createDataFrame([(batch_id, n)], LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger/{batch_id}")
    return True


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the batches that the ledger names, with ``batch_id``."""
    whole = T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())])
    if not _exists(spark, f"{path}/rows"):
        return spark.createDataFrame([], whole)
    rows = spark.read.schema(whole).parquet(f"{path}/rows")
    return rows.join(applied_batches(spark, path).select("batch_id"), "batch_id", "left_semi").select(*whole.names)


def append_batch_jdbc(df: DataFrame, batch_id: str, url: str, table: str, ledger: str, keys: Sequence[str],
                      properties: Mapping[str, str] | None = None) -> bool:
    """Append the rows of a batch to a relational table that has a column ``batch_id``, once; False if it was applied.

    The ledger, a table (batch_id, n_rows), gets its row after all rows are in. Tasks commit
    one by one, so a run that dies may leave some rows of the batch: the next run compares
    the batch's stored keys, adds what is missing, and writes the ledger.
    """
    spark, props = df.sparkSession, dict(properties or {})
    if not spark.read.jdbc(url, ledger, properties=props).where(F.col("batch_id") == batch_id).isEmpty():
        return False
    rows = scratch_table(df.withColumn("batch_id", F.lit(batch_id)), "batch")
    stored = spark.read.jdbc(url, table, properties=props).where(F.col("batch_id") == batch_id).select(*keys)
    append_jdbc(new_rows(rows, scratch_table(stored, "stored_keys"), keys), url, table, props)
    append_jdbc(spark.createDataFrame([(batch_id, rows.count())], LEDGER), url, ledger, props)
    return True
