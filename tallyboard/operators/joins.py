"""Equi-joins on null-safe keys that hold up when one key owns much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from tallyboard.functions import all_equal, all_null_safe_equal

# A side is broadcast only after it has been measured to be within both bounds.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024

# A key with at least this many rows is joined apart from the others.
HOT_ROWS = 1_000_000
HOT_KEYS = 64

# Frequent keys are sketched in separate buckets of the key space, so that the sketches
# of many tasks are merged by many tasks, too.
SKETCH_BUCKETS = 64
SKETCH_ITEMS = 1_024


def _name(c: str) -> Column:
    return F.col(f"`{c}`")


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes, from one map-side combined aggregate."""
    width = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(_name(f.name)), F.lit(0)) + F.lit(16)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            width = width + F.octet_length(F.to_json(F.struct(_name(f.name))))
        else:
            width = width + F.lit(8)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return row["n"], row["b"] or 0


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """A broadcast hint for a side measured to be small, else the side unchanged.

    Without the hint the join is a shuffle join, whose skewed partitions are
    split at run time.
    """
    rows, size = measured_size(df)
    return F.broadcast(df) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def _common_type(spark: SparkSession, a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which keys of two types are compared, as Spark's equality compares them."""
    if a == b:
        return a
    for text, other in ((a, b), (b, a)):
        if isinstance(text, T.StringType):
            return T.LongType() if isinstance(other, T.IntegralType) else \
                T.DoubleType() if isinstance(other, T.NumericType) else other
    schemas = [T.StructType([T.StructField("k", t)]) for t in (a, b)]
    first, second = (spark.createDataFrame([], s) for s in schemas)
    return first.union(second).schema["k"].dataType


def _key_types(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]) -> list[T.DataType]:
    return [_common_type(left.sparkSession, left.schema[a].dataType, right.schema[b].dataType)
            for a, b in zip(left_keys, right_keys, strict=True)]


def _keys_as(df: DataFrame, keys: Sequence[str], types: Sequence[T.DataType]) -> list[Column]:
    return [_name(k) if df.schema[k].dataType == t else _name(k).cast(t) for k, t in zip(keys, types, strict=True)]


def _key_hash(df: DataFrame, keys: Sequence[str], types: Sequence[T.DataType]) -> Column:
    # Keys that compare equal must hash alike: a negative zero is made positive.
    return F.xxhash64(*[c + F.lit(0.0).cast(t) if isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType) else c
                        for c, t in zip(_keys_as(df, keys, types), types)])


def hot_key_hashes(df: DataFrame, keys: Sequence[str], types: Sequence[T.DataType],
                   hot_rows: int | None = None) -> list[int]:
    """Hashes of the keys that own at least ``hot_rows`` rows: at most HOT_KEYS of them.

    Frequent-items sketches of fixed size per task; only the key columns are read
    and at most HOT_KEYS rows reach the driver. Which keys are found decides how
    rows travel, never what a join returns.
    """
    hashed = df.select(_key_hash(df, keys, types).alias("h"))
    buckets = hashed.groupBy(F.pmod(F.col("h"), F.lit(SKETCH_BUCKETS)).alias("bucket")).agg(
        F.expr(f"approx_top_k(h, {HOT_KEYS}, {SKETCH_ITEMS})").alias("top"))
    found = buckets.select(F.explode("top").alias("t")).select("t.item", "t.count").where(
        F.col("count") >= F.lit(HOT_ROWS if hot_rows is None else hot_rows))
    return [r["item"] for r in found.orderBy(F.col("count").desc()).limit(HOT_KEYS).collect()]


def key_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
             how: str, nulls_match: bool = True) -> DataFrame:
    """Equi-join whose right key columns are dropped. Null keys match null keys.

    Keys of different types meet in their common type. For keys known to hold no
    null, ``nulls_match=False`` plans plain equality; a side that was grouped or
    joined on these keys before is then not shuffled again.
    """
    # Own names for the right keys keep the condition unambiguous.
    own = {k: f"__{k}" for k in right_keys}
    renamed = right.withColumnsRenamed(own)
    types = _key_types(left, right, left_keys, right_keys)
    equal = all_null_safe_equal if nulls_match else all_equal
    cond = equal(_keys_as(left, left_keys, types), _keys_as(renamed, [own[k] for k in right_keys], types))
    return left.join(renamed, cond, how).drop(*own.values())


def skew_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
              right_keys: Sequence[str] | None = None, how: str = "left",
              hot_rows: int | None = None, nulls_match: bool = True) -> DataFrame:
    """Join for a left side in which a few keys may own most rows.

    Rows of hot keys stay where they are and meet a broadcast of the right rows
    for just those keys; all other rows take the ordinary shuffle join. Every
    left row is in exactly one of the two parts, and both sides are divided by a
    hash of the common key type, so inner, left, semi and anti joins keep their
    results. If the right rows of the hot keys are not small, one shuffle join
    does it all.
    """
    right_keys = list(left_keys if right_keys is None else right_keys)
    types = _key_types(left, right, left_keys, right_keys)
    hot = hot_key_hashes(left, left_keys, types, hot_rows)
    if not hot:
        return key_join(left, right, left_keys, right_keys, how, nulls_match)
    in_left = _key_hash(left, left_keys, types).isin(hot)
    in_right = _key_hash(right, right_keys, types).isin(hot)
    hot_right = right.where(in_right)
    rows, size = measured_size(hot_right)
    if rows > BROADCAST_ROWS or size > BROADCAST_BYTES:
        return key_join(left, right, left_keys, right_keys, how, nulls_match)
    cold = key_join(left.where(~in_left), right.where(~in_right), left_keys, right_keys, how, nulls_match)
    return cold.unionByName(key_join(left.where(in_left), F.broadcast(hot_right),
                                     left_keys, right_keys, how, nulls_match))


def merge_stats(tables: Sequence[DataFrame], keys: Sequence[str], nulls_match: bool = True) -> DataFrame:
    """Inner join of n stats tables on keys that are unique in each of them.

    All joins use the same keys, so each table is shuffled once at most.
    """
    return reduce(lambda a, b: key_join(a, b, keys, keys, "inner", nulls_match), tables)


def merge_stats_watched(tables: Sequence[DataFrame], keys: Sequence[str], set_keys: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``merge_stats`` and its audit in one pass over the tables.

    The observation, complete once the result was written, holds for each table the number of
    keys that it repeats (``repeated_1``, ...), and the number of rows whose ``set_keys`` (some
    of the keys, such as the player) some table lacks altogether (``not_in_every_table``). Each
    table moves once, by ``set_keys``; rows of a key are counted where they are read.
    """
    n = len(tables)
    own = [[c for c in t.columns if c not in keys] for t in tables]
    tagged = [t.select(*[_name(k) for k in keys], *[
        (F.struct(*[_name(c) for c in own[j]]) if i == j else F.lit(None)).cast(T.StructType([t2.schema[c] for c in own[j]])).alias(f"__t{j}")
        for j, t2 in enumerate(tables)], *[F.lit(int(i == j)).cast("bigint").alias(f"__n{j}") for j in range(n)]) for i, t in enumerate(tables)]
    rows = reduce(DataFrame.unionByName, tagged).groupBy(*keys).agg(
        *[F.any_value(f"__t{j}", True).alias(f"__t{j}") for j in range(n)], *[F.sum(f"__n{j}").alias(f"__n{j}") for j in range(n)])
    held = Window.partitionBy(*[_name(k) for k in set_keys])
    rows = rows.withColumn("__everywhere", F.least(*[F.max(f"__n{j}").over(held) for j in range(n)]))
    watch = Observation()
    rows = rows.observe(watch, F.count_if(F.col("__everywhere") == 0).alias("not_in_every_table"),
                        *[F.count_if(F.col(f"__n{j}") > 1).alias(f"repeated_{j + 1}") for j in range(n)])
    inner = rows.where(" AND ".join(f"__n{j} > 0" for j in range(n)))
    return inner.select(*[_name(k) for k in keys], *[F.col(f"__t{j}.`{c}`").alias(c) for j in range(n) for c in own[j]]), watch


def with_standings(stats: DataFrame, standings: DataFrame, keys: Sequence[str] = ("Tm",)) -> DataFrame:
    """Stats left join standings: a few dozen teams per season, broadcast when measured small."""
    return key_join(stats, broadcast_if_small(standings), keys, keys, "left")


def with_awards(stats: DataFrame, awards: DataFrame, landed: bool = True, nulls_match: bool = True) -> DataFrame:
    """Stats left join award votes on player and season; traded players repeat their share.

    A landed award table is measured and broadcast when small. Votes that are
    still to be computed would be computed twice by that; with ``landed=False``
    the choice is left to run-time planning.
    """
    awards = awards.withColumn("__season", F.col("award_season"))
    awards = broadcast_if_small(awards) if landed else awards
    return key_join(stats, awards, ["Player", "season"], ["Player", "__season"], "left", nulls_match)


def with_awards_watched(stats: DataFrame, awards: DataFrame) -> tuple[DataFrame, Observation]:
    """``with_awards``, and an observation of the award votes whose player and season the stats lack (``votes_without_stats``)."""
    votes = awards.withColumns({"__season": F.col("award_season"), "__vote": F.lit(True)})
    both = key_join(stats.withColumn("__stats", F.lit(True)), votes, ["Player", "season"], ["Player", "__season"], "full")
    watch = Observation()
    both = both.observe(watch, F.count_if(F.col("__stats").isNull()).alias("votes_without_stats"))
    return both.where("__stats").drop("__stats", "__vote"), watch


class NotOneToOne(ValueError):
    """A key occurs more than once on a side of a one-to-one join."""


def guard_unique(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """The table, which raises while it is computed if a key occurs twice, and names the key.

    No job runs before the action: the repeated key is looked for by a subquery of the same
    plan, over the key columns alone, combined where they are read.
    """
    again = df.groupBy(*[_name(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    first = again.agg(F.min(F.to_json(F.struct(*[_name(k).cast("string").alias(k) for k in keys]), {"ignoreNullFields": "false"}))).scalar()
    message = F.concat(F.lit(f"{label} repeats the key "), first)
    return df.where(F.when(first.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", labels: Sequence[str] = ("left side", "right side")) -> DataFrame:
    """Equi-join that raises from within its own plan if either side repeats a key."""
    return key_join(guard_unique(left, keys, labels[0]), guard_unique(right, keys, labels[1]), keys, keys, how)


def missing_keys(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
                 hot_rows: int | None = None, nulls_match: bool = True) -> DataFrame:
    """Left rows whose key the right side lacks; repeated left rows stay repeated.

    The right side shrinks to distinct keys before it is shuffled, and hot left
    keys are joined apart.
    """
    keys = right.select(*[_name(k) for k in right_keys]).distinct()
    return skew_join(left, keys, left_keys, right_keys, "left_anti", hot_rows, nulls_match)
