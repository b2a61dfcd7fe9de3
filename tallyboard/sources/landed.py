"""Readers of landed Parquet tables."""

from __future__ import annotations

import os.path
from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyboard import schemas as S
from tallyboard.sources.census import (Signature, census, common_schema, files_of, from_nanoseconds, inferred, nanosecond_columns,
                                       one_file, read_alike, signature)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One Parquet table. A given schema saves the footer pass and fills absent columns with null.

    Nanosecond timestamps, which pandas writes, come in microseconds, rounded down. Files of
    one table are taken to agree in that; only a schema with timestamps costs a footer.
    """
    if schema and not any(isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) for f in schema.fields):
        return spark.read.schema(schema).parquet(path)
    found = inferred(spark, path)
    if found is not None:
        return spark.read.schema(schema).parquet(path) if schema else found
    columns = signature(spark, one_file(spark, path))
    if not schema:
        return read_alike(spark, [path], columns)
    nanos = nanosecond_columns(columns)
    read_alike(spark, [path], columns)
    stored = T.StructType([T.StructField(f.name, T.LongType() if f.name in nanos else f.dataType) for f in schema.fields])
    found = from_nanoseconds(spark.read.schema(stored).parquet(path), nanos)
    return found.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def _years(seasons: Iterable[str | int]) -> list[int]:
    return [int(str(s)[:4]) for s in seasons]


def seasons_of(spark: SparkSession, path: str) -> list[str]:
    """Seasons that a table partitioned by ``season_year`` holds: one row per season reaches the driver."""
    found = files_of_seasons(spark, path)
    return sorted({os.path.dirname(f).rsplit("season_year=", 1)[1].split("/")[0] for f in found})


def files_of_seasons(spark: SparkSession, path: str, years: Sequence[int] | None = None) -> list[str]:
    return files_of(spark, path, None if years is None else F.col("season_year").isin(list(years)))


def read_seasons(spark: SparkSession, path: str, seasons: Iterable[str | int],
                 schema: T.StructType | None = None, widen: bool | None = None) -> DataFrame:
    """Seasons of a table partitioned by ``season_year``.

    The season list becomes a partition filter, so other seasons' files are not opened.

    Long histories hold files whose columns differ. With ``widen``, which is the default
    where no schema is given, a census of the footers groups the files by their columns;
    every group is one read, in its own types, and the groups are put together by name in
    the widest type of each column, absent columns as null. Text and numbers have no common
    type: that raises, with a file of either kind. Files that agree are one read, as with a
    schema. Without ``widen``, files that lack a column of the schema give null there, and
    the types must be those of the schema.
    """
    years = _years(seasons)
    if widen is False or schema is not None and not widen:
        return read_table(spark, path, schema).where(F.col("season_year").isin(years))
    groups = census(spark, files_of_seasons(spark, path, years))
    found = _read_groups(spark, path, years, groups)
    if schema is not None:
        found = found.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in found.columns
                               else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return found


def _read_groups(spark: SparkSession, path: str, years: list[int], groups: dict[Signature, list[str]]) -> DataFrame:
    if not groups:
        return read_table(spark, path).where(F.col("season_year").isin(years))
    if len(groups) == 1:
        (columns, files), = groups.items()
        return read_alike(spark, [path], columns, path, files[0]).where(F.col("season_year").isin(years))
    folders: dict[str, set[Signature]] = defaultdict(set)
    for columns, files in groups.items():
        for f in files:
            folders[os.path.dirname(f)].add(columns)
    parts = []
    for columns, files in groups.items():
        # A folder whose files agree is named as a whole, which keeps the list of paths short.
        paths = sorted({os.path.dirname(f) if len(folders[os.path.dirname(f)]) == 1 else f for f in files})
        parts.append((files[0], read_alike(spark, paths, columns, path)))
    whole = common_schema((file, df.drop("season_year").schema) for file, df in parts)
    names = [*whole.names, "season_year"]
    kinds = {f.name: f.dataType for f in whole.fields}

    def fitted(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{n}`") if n not in kinds or n in df.columns and df.schema[n].dataType == kinds[n]
                           else (F.col(f"`{n}`") if n in df.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in names])

    return reduce(DataFrame.unionByName, [fitted(df) for _, df in parts])


def read_player_stats(spark: SparkSession, base: str, info: str, seasons: Iterable[str | int],
                      schema: T.StructType | None = None) -> DataFrame:
    """Raw player stats of one kind, from ``{base}/stats/info={info}/season_year=...``."""
    if info not in S.INFOS:
        raise ValueError(f"info must be one of {S.INFOS}")
    return read_seasons(spark, f"{base}/stats/info={info}", seasons, schema)


def read_standings(spark: SparkSession, base: str, seasons: Iterable[str | int],
                   schema: T.StructType | None = None) -> DataFrame:
    """Raw standings, from ``{base}/standings/season_year=...``."""
    return read_seasons(spark, f"{base}/standings", seasons, schema)


def read_awards(spark: SparkSession, path: str) -> DataFrame:
    """Landed award votes. A season column named ``Season`` would collide with the stats' ``season``."""
    votes = read_table(spark, path).withColumnRenamed("Season", "award_season")
    return votes.select(*S.AWARD_SCHEMA.names)


def union_seasons(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of several tables, columns matched by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
