"""Pick up newly landed files and append them to a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyboard.session import scratch_table
from tallyboard.sinks.relational import append_jdbc, existing_keys, new_rows

BatchSink = Callable[[DataFrame, int], None]
OBJECTS = 1_000  # objects that one read opens; so many names are on the driver at a time


def ingest_new_files(spark: SparkSession, folder: str, schema: T.StructType, checkpoint: str,
                     sink: BatchSink, glob: str = "*.parquet",
                     bytes_per_batch: int = 100 * 1024 ** 3, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Stream Parquet files not seen before into ``sink(batch, batch_id)``.

    The checkpoint remembers the files taken, so a restart does not repeat them.
    By default all files present are taken, in batches of bounded size, and the
    query stops; pass ``trigger`` to keep it running.
    """
    files = (spark.readStream.schema(schema).option("pathGlobFilter", glob)
             .option("maxBytesPerTrigger", bytes_per_batch).parquet(folder))
    return (files.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def append_batches(path: str) -> BatchSink:
    """Sink to a Parquet table with one partition per batch.

    A batch that is run again after a failure replaces its own partition, so
    every row lands once.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
    return sink


def append_new_to_jdbc(url: str, table: str, keys: Sequence[str], split_by: str = "snapshot_date",
                       properties: Mapping[str, str] | None = None) -> BatchSink:
    """Sink to a relational table; a repeated batch adds only rows the table lacks."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        # The batch is read for its range, for the comparison and for the write.
        rows = scratch_table(batch, "batch")
        known = existing_keys(rows, url, table, keys, split_by, properties)
        append_jdbc(new_rows(rows, known, keys), url, table, properties)
    return sink


_EVENT = "Records array<struct<s3: struct<object: struct<key: string>>>>"


def event_keys(events: DataFrame, column: str = "event", prefix: str = "data/raw/players/") -> DataFrame:
    """Object keys named by object-created events, URL-decoded; all records of an event count."""
    record = F.explode(F.from_json(F.col(column), _EVENT)["Records"]).alias("record")
    keys = events.select(record).select(F.url_decode("record.s3.object.key").alias("key"))
    return keys.where(F.col("key").startswith(prefix))


def key_groups(keys: DataFrame, objects: int) -> Iterator[list[str]]:
    """Keys in order, ``objects`` at a time."""
    held: list[str] = []
    for row in keys.orderBy("key").toLocalIterator():  # one partition of names at a time
        held.append(row["key"])
        if len(held) == objects:
            yield held
            held = []
    if held:
        yield held


def append_named_objects(events: DataFrame, root: str, schema: T.StructType, append: Callable[[DataFrame], None],
                         column: str = "event", prefix: str = "data/raw/players/", objects: int = OBJECTS) -> int:
    """Append the rows of the objects that events name; returns how many objects there were.

    An object named twice is appended once. Objects are opened ``objects`` at a time, one read
    and one append each; the names of these, and no rows, are on the driver. A call that fails
    has appended the groups before, and one that is repeated appends again:
    ``land_noticed_objects`` lands each object once.
    """
    # Names and no rows; written once, as they are read in groups.
    keys, n = scratch_table(event_keys(events, column, prefix).distinct(), "named_objects"), 0
    for names in key_groups(keys, objects):
        append(events.sparkSession.read.schema(schema).parquet(*[f"{root}/{k}" for k in names]))
        n += len(names)
    return n
