"""Publish a table after its audit: readers see a whole, audited version or the one before it."""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, types as T

from tallyboard.operators.quality import QualityError


class PublishConflict(RuntimeError):
    """Another publisher was first."""


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, path: str) -> list[int]:
    at, fs = _fs(spark, f"{path}/published")
    if not fs.exists(at):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(at) if s.getPath().getName().isdigit())


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the published version; None before the first."""
    numbers = _pointers(spark, path)
    if not numbers:
        return None
    at, fs = _fs(spark, f"{path}/published/{numbers[-1]:010d}")
    opened = fs.open(at)
    try:
        return f"{path}/versions/{bytes(opened.readAllBytes()).decode()}"
    finally:
        opened.close()


def _point(spark: SparkSession, path: str, version: str, number: int) -> None:
    """A pointer file appears whole, by one move, under a number that only one publisher can take."""
    draft, fs = _fs(spark, f"{path}/published/.{version}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    target, _ = _fs(spark, f"{path}/published/{number:010d}")
    try:
        moved = not fs.exists(target) and fs.rename(draft, target)
    except CapturedException:
        moved = False
    if not moved:
        fs.delete(draft, False)
        raise PublishConflict(f"version {number} of {path} was published by someone else")


def publish(df: DataFrame, path: str, gates: Mapping[str, Column] | None = None, watched: Observation | None = None) -> str:
    """Stage a table, audit it by what was observed while it was written, and only then publish it.

    A gate is an aggregate over ``df`` that must be zero, such as a count of bad rows. A
    caller that observes at an earlier point of the plan hands over its ``watched``
    observation, whose metrics must all be zero. Nothing is read a second time. If a gate
    fails the staged copy is deleted, ``QualityError`` names the gate, and readers keep the
    version before. A task that runs twice may be counted twice: zero stays zero.

    Returns the folder of the new version. Versions before it stay for those who read them;
    ``drop_versions`` removes them.
    """
    spark, version = df.sparkSession, uuid4().hex
    number = (_pointers(spark, path) or [0])[-1] + 1
    watches = [watched] if watched else []
    if gates:
        own = Observation()
        df = df.observe(own, *[c.alias(n) for n, c in gates.items()])
        watches.append(own)
    staged = f"{path}/versions/{version}"
    df.write.parquet(staged)
    found = {n: v for w in watches for n, v in w.get.items()}
    failed = {n: v for n, v in found.items() if v}
    if failed:
        at, fs = _fs(spark, staged)
        fs.delete(at, True)
        raise QualityError("; ".join(f"{n}: {v}" for n, v in failed.items()))
    _point(spark, path, version, number)
    return staged


def read_published(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The published version, whole, whatever is published while it is read."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing is published under {path}")
    return (spark.read.schema(schema) if schema else spark.read).parquet(version)


def drop_versions(spark: SparkSession, path: str) -> int:
    """Delete all versions but the published one, also those of publishers that died; returns how many.

    For a time when nobody reads an older version or publishes.
    """
    at, fs = _fs(spark, f"{path}/versions")
    keep = (current_version(spark, path) or "").rsplit("/", 1)[-1]
    old = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName() != keep] if fs.exists(at) else []
    for p in old:
        fs.delete(p, True)
    return len(old)
