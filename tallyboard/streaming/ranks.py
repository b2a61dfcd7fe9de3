"""A rank history that grows with the dated rank files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyboard.operators.ranking import rank_history
from tallyboard.session import scratch_table
from tallyboard.sinks import overwrite_partitions
from tallyboard.sources.ranks import CSV


def newest_files(ranks: DataFrame, run: str, file: str, changed: str) -> DataFrame:
    """Of each run the rows of its newest file, of equally new ones the last by path.

    A run sent twice before it is picked up must not land twice. Files are told apart by one
    row each.
    """
    files = ranks.select(run, file, changed).distinct()
    last = F.row_number().over(Window.partitionBy(run).orderBy(F.col(changed).desc(), F.col(file).desc()))
    chosen = files.withColumn("__last", last).where("__last = 1").select(F.col(file).alias("__chosen"))
    return ranks.join(chosen, F.col(file) == F.col("__chosen"), "left_semi")


def stream_rank_history(spark: SparkSession, ranks: str, out: str, schema: T.StructType, checkpoint: str, order: Sequence[Column], player: str,
                        pattern: str = r"(\d{2}_\d{2}_\d{4})", date_format: str = "dd_MM_yyyy", files_per_batch: int = 1_000,
                        trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Add the rank files that have come since the last start to the history, landed by ``Date``.

    The run's date is taken from the file's path, one file a run; the run replaces its own
    partition and no other, so a run that is sent again, or a batch that runs again, lands
    once. Files read before are not opened again.
    """
    files = (spark.readStream.schema(schema).options(**CSV, multiLine=True, nullValue="\0", recursiveFileLookup=True)
             .option("maxFilesPerTrigger", files_per_batch).csv(ranks))
    dated = files.select("*", F.to_date(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1), date_format).alias("run_date"),
                         F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_modification_time").alias("__changed"))

    def land(batch: DataFrame, batch_id: int) -> None:
        # Top-n tables of the runs that came; written once, as the files are told apart before their rows are ranked.
        newest = newest_files(scratch_table(batch, "ranks"), "run_date", "__file", "__changed")
        overwrite_partitions(rank_history(newest, "run_date", order, player), out, ["Date"])

    return (dated.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
