"""Data-quality checks: key sets, duplicates, name matches, value counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyboard.operators.joins import missing_keys
from tallyboard.operators.ranking import rank_all


class QualityError(ValueError):
    """A data-quality rule does not hold."""


def _tagged(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        t.select(*keys, F.lit(i).alias("__table"), F.lit(1 << i).cast("bigint").alias("__bit"))
        for i, t in enumerate(tables)])


def key_presence(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Per key, a bit mask of the tables that hold it. One shuffle, combined map-side."""
    return _tagged(tables, keys).groupBy(*keys).agg(F.bit_or("__bit").alias("tables"))


def key_set_summary(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row: number of keys, and whether every table holds all of them."""
    full = (1 << len(tables)) - 1
    return key_presence(tables, keys).agg(
        F.count(F.lit(1)).alias("n_keys"),
        (F.count_if(F.col("tables") != full) == 0).alias("sets_equal"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Nulls compare equal."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: Sequence[str], label: str = "table") -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise QualityError(f"{label} has duplicates on {list(keys)}")


def check_stats(tables: Sequence[DataFrame], seasons: Sequence[str] = ()) -> None:
    """Same players in every table, and no duplicate (player, team) in any; else raise.

    Both rules come out of one pass: counts per (player, team), rolled up to
    players. The driver receives a single row.
    """
    n = len(tables)
    full_key = [*seasons, "Player", "Tm"]
    counts = _tagged(tables, full_key).groupBy(*full_key).agg(
        *[F.count_if(F.col("__table") == i).alias(f"n{i}") for i in range(n)])
    players = counts.groupBy(*seasons, "Player").agg(
        *[F.max(f"n{i}").alias(f"n{i}") for i in range(n)])
    row = players.agg(
        F.count_if(F.least(*[F.col(f"n{i}") for i in range(n)]) == 0).alias("unequal"),
        *[F.count_if(F.col(f"n{i}") > 1).alias(f"dup{i}") for i in range(n)]).first()
    if row["unequal"]:
        raise QualityError(f"{row['unequal']} players are not in every table")
    for i in range(n):
        if row[f"dup{i}"]:
            raise QualityError(f"table {i + 1} has duplicates on {full_key}")


def name_match(awards: DataFrame, stats: DataFrame, award_keys: Sequence[str] = ("Player",),
               stats_keys: Sequence[str] = ("Player",), season: str = "award_season") -> DataFrame:
    """Per award season: distinct award players, and how many of them the stats lack.

    With only the player as key, a player counts as found whatever the season;
    add the season columns to the keys for the strict form.
    """
    keys = [f"__{i}" for i in range(len(award_keys))]
    wanted = awards.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(award_keys, keys, strict=True)],
                           F.struct(F.col(season).alias("season")).alias("__season"), F.lit(False).alias("__known"))
    known = stats.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(stats_keys, keys, strict=True)],
                         F.lit(None).cast(wanted.schema["__season"].dataType).alias("__season"),
                         F.lit(True).alias("__known"))
    # One row per key: whether the stats hold it, and the award seasons that name it. Both
    # shrink map-side, and the rows of a key meet once. Null keys match.
    names = wanted.unionByName(known).groupBy(*keys).agg(
        F.bool_or("__known").alias("__found"), F.collect_set("__season").alias("__seasons"))
    return names.select("__found", F.explode("__seasons").alias("__season")).groupBy(
        F.col("__season.season").alias(season)).agg(
        F.count(F.lit(1)).alias("n_award"), F.count_if(~F.col("__found")).alias("n_unmatched"))


def names_match(awards: DataFrame, stats: DataFrame, seasons: Sequence[str],
                strict: bool = False) -> bool:
    """True when every award player of the listed season labels occurs in the stats."""
    listed = awards.where(F.col("award_season").isin(list(seasons)))
    keys = (["Player", "award_season"], ["Player", "season"]) if strict else (["Player"], ["Player"])
    return name_match(listed, stats, *keys).where("n_unmatched > 0").isEmpty()


def missing_players(awards: DataFrame, stats: DataFrame, strict: bool = True) -> DataFrame:
    """Award rows whose player, with ``strict`` in that season, has no stats row."""
    keys = (["Player", "award_season"], ["Player", "season"]) if strict else (["Player"], ["Player"])
    return missing_keys(awards.select("Player", "award_season"), stats, *keys)


def value_counts(df: DataFrame, by: Sequence[str], value: str, order: str = "ord") -> DataFrame:
    """Count of each value per group, and its place by falling count, ties by value."""
    # How many values a group has at most is estimated from the input, so that the counts
    # themselves are made once; the estimate is off by a few percent.
    values = df.groupBy(*by).agg(F.approx_count_distinct(value).alias("n")).agg(F.max("n")).first()[0] or 0
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return rank_all(counts, by, [F.col("n").desc(), F.col(value).asc()], order, largest=2 * values + 1)
