"""Object-created notices as a stream: every named object lands once."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyboard.session import scratch_table
from tallyboard.streaming.ingest import OBJECTS, event_keys, key_groups

THREADS = 16


def _present(spark: SparkSession, paths: list[str]) -> list[bool]:
    hadoop = spark._jsc.hadoopConfiguration()

    def there(path: str) -> bool:
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(hadoop).exists(found)
    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(there, paths))


class NoticeSink:
    """Lands the objects that a batch of notices names for the first time.

    Rows go to ``{out}/rows/batch_id=B/part=P``, names of objects that are not there to
    ``{out}/missing/batch_id=B``. Every batch tries
    those that the batch before it reported again, so an object that arrives late lands with
    a later batch, and the last batch's report says what is still missing. A batch that runs
    again replaces its own folders.

    Objects are opened ``objects`` at a time, one read each: that many names are on the driver.
    """

    def __init__(self, root: str, out: str, schema: T.StructType, objects: int = OBJECTS):
        self.root, self.out, self.schema, self.objects = root.rstrip("/"), out.rstrip("/"), schema, objects

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Names and no rows; written once, as they are read in groups and counted again on replay.
        keys = scratch_table(batch.select("key").unionByName(self._missing_before(spark, batch_id)).distinct(), "notices")
        rows = f"{self.out}/rows/batch_id={batch_id}"
        # A run that failed may have left more parts than this one makes.
        self._delete(spark, rows)
        absent: list[DataFrame] = []
        for part, names in enumerate(key_groups(keys, self.objects)):
            there = dict(zip(names, _present(spark, [f"{self.root}/{n}" for n in names])))
            found = [n for n, ok in there.items() if ok]
            if found:
                spark.read.schema(self.schema).parquet(*[f"{self.root}/{n}" for n in found]).write.mode("overwrite").parquet(f"{rows}/part={part}")
            gone = [(n,) for n, ok in there.items() if not ok]
            if gone:
                absent.append(scratch_table(spark.createDataFrame(gone, "key string"), "missing"))
        # One row without a key, so that a batch with nothing missing has a report, too.
        report = spark.createDataFrame([(None,)], "key string")
        for a in absent:
            report = report.unionByName(a)
        report.coalesce(1).write.mode("overwrite").parquet(f"{self.out}/missing/batch_id={batch_id}")

    def _missing_before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        folder = f"{self.out}/missing/batch_id={batch_id - 1}"
        if batch_id == 0 or not _present(spark, [folder])[0]:
            return spark.createDataFrame([], "key string")
        return spark.read.schema("key string").parquet(folder).where(F.col("key").isNotNull())

    @staticmethod
    def _delete(spark: SparkSession, path: str) -> None:
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def first_notices(notices: DataFrame) -> DataFrame:
    """Keys that no earlier notice of the stream named; the state holds the keys seen."""
    return notices.dropDuplicates(["key"])


def land_noticed_objects(spark: SparkSession, notices: str, root: str, out: str, schema: T.StructType, checkpoint: str,
                         prefix: str = "data/raw/players/", objects: int = OBJECTS, files_per_batch: int = 1_000,
                         trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Stream notices (one JSON text per line, files under ``notices``) and land each object that they name, once.

    A notice that is sent again, in the same file, a later file or a later run, adds nothing:
    its key is in the state that the checkpoint keeps. On a cluster let the state lie in
    RocksDB, as it grows with the number of objects ever named.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(notices)
    keys = first_notices(event_keys(lines, "value", prefix))
    return (keys.writeStream.foreachBatch(NoticeSink(root, out, schema, objects)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def landed_objects(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """Rows of all objects landed so far."""
    return spark.read.schema(schema).parquet(f"{out.rstrip('/')}/rows").select(*schema.names)


def missing_objects(spark: SparkSession, out: str) -> DataFrame:
    """Keys of objects that are still missing after the last batch."""
    reports = spark.read.schema("key string, batch_id bigint").parquet(f"{out.rstrip('/')}/missing")
    last = reports.agg(F.max("batch_id")).scalar()
    return reports.where((F.col("batch_id") == last) & F.col("key").isNotNull()).select("key")
