"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning carries most of the scale-out: skewed shuffle joins are
# split, small measured sides are broadcast, rebalanced writes are evened out.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "tallyboard", **extra: str) -> SparkSession:
    """A session with the library's settings; a cluster's own settings stay in force otherwise."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS, **extra)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local-mode session without the setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyboard-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets, and that ``drop_scratch`` deletes."""
    _scratch.append(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    return _scratch[-1]


def scratch_table(df: DataFrame, name: str = "table") -> DataFrame:
    """Write once, read back: later stages restart from files, not from the whole lineage.

    Parquet rather than a row checkpoint, so that each later reader fetches only
    the columns it uses.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all scratch paths of this process, once no result that reads them is needed."""
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Give a Python stage all cores when its input comes in fewer pieces than that.

    Large inputs come in more pieces and are left as they are. Meant for a table
    scan: counting the pieces of a plan with shuffles would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
