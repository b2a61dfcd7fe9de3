"""Ranks, top-n tables and the consensus order of several rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyboard import schemas as S
from tallyboard.functions import np_round
from tallyboard.session import scratch_table

# monotonically_increasing_id puts the partition number above this bit.
_PARTITION_BITS = 33

# Rows of one group that a single task may number: they are narrow and can spill.
GROUP_ROWS = 5_000_000


def rank_all(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "pos",
             group_rows: int = GROUP_ROWS, largest: int | None = None) -> DataFrame:
    """Unique 1-based position of every row in its group, however large the group.

    The largest group is measured by a count of the group columns alone, unless the
    caller knows a bound for it. Groups that fit a task are numbered by a window and
    nothing is written; beyond that, positions are worked out across partitions.
    ``order`` must end in columns that make rows of a group distinct.
    """
    if largest is None:
        largest = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest > group_rows:
        return _rank_across_partitions(df, by, order, name)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint")
    return df.withColumn(name, rank)


def _rank_across_partitions(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Positions in groups too large for one task, such as all rows of one of five models.

    The rows are range-partitioned on (group, order), numbered within their
    partition, and written; a table of at most (groups + partitions) rows then
    gives each run of a group its starting position.
    """
    layout = [F.col(c) for c in by] + list(order)
    numbered = (df.repartitionByRange(*layout).sortWithinPartitions(*layout)
                .withColumn("__row", F.monotonically_increasing_id()))
    rows = scratch_table(numbered, "numbered").withColumn(
        "__part", F.shiftright(F.col("__row"), _PARTITION_BITS))
    runs = rows.groupBy(*by, "__part").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        *[F.col(c).alias(f"__{c}") for c in by], F.col("__part").alias("__run"),
        (F.col("__first") - F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - 1).alias("__start"))
    same = F.col("__part") == F.col("__run")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return rows.join(starts, same).select(*[F.col(f"`{c}`") for c in df.columns],
                                          (F.col("__row") - F.col("__start")).alias(name))


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, name: str = "pos") -> DataFrame:
    """First ``n`` rows of every group with their positions.

    Each task keeps at most ``n`` rows per group before the shuffle.
    """
    if not by:
        df = df.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint")
    return df.withColumn(name, rank).where(F.col(name) <= n)


def rank_models(scored: DataFrame, by: Sequence[str] = (), player: str = "player", players: DataFrame | None = None) -> DataFrame:
    """Every player's position in every model: falling share, ties by player.

    A model scores each row of ``players``, the table the scores were made of, once. Given
    that table, its largest run bounds the groups, and no model predicts just to be counted.
    """
    largest = None
    if players is not None:
        largest = players.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    return rank_all(scored, [*by, "model"], [F.col("share").desc_nulls_last(), F.col(player).asc()], largest=largest)


def top_models(scored: DataFrame, n: int = 10, by: Sequence[str] = (), player: str = "player") -> DataFrame:
    """The ``n`` best players of every model, with shares to three decimals."""
    best = top_n(scored, [*by, "model"], [F.col("share").desc_nulls_last(), F.col(player).asc()], n)
    return best.withColumn("share", np_round(F.col("share"), 3))


def _per_model(model: str, value: str) -> Column:
    # One value per model and row, so any aggregate that skips nulls picks it; unlike a
    # pivot this takes a single shuffle.
    return F.max(F.when(F.col("model") == model, F.col(value)))


def wide_ranks(top: DataFrame, models: Sequence[str] = S.MODELS, by: Sequence[str] = (),
               player: str = "player") -> DataFrame:
    """Top-n rows side by side: ``MVP RANK m`` and ``MVP SHARE m`` per model, one row per position."""
    return top.groupBy(*by, "pos").agg(*[c for m in models for c in (
        _per_model(m, player).alias(f"MVP RANK {m}"), _per_model(m, "share").alias(f"MVP SHARE {m}"))])


def wide_results(ranked: DataFrame, models: Sequence[str] = S.MODELS, by: Sequence[str] = (),
                 player: str = "player") -> DataFrame:
    """One row per player with share and rank of every model; players some model lacks are left out."""
    wide = ranked.groupBy(*by, player).agg(*[c for m in models for c in (
        _per_model(m, "share").alias(f"PREDICTED MVP SHARE {m}"), _per_model(m, "pos").alias(f"MVP RANK {m}"))])
    return wide.dropna(subset=[f"MVP RANK {m}" for m in models])


def consensus(top: DataFrame, by: Sequence[str] = (), player: str = "player", n: int = 10,
              majority: int = 3, tie_break: Sequence[str] = S.TIE_BREAK_MODELS,
              tie_majority: int = 2) -> DataFrame:
    """Merge the models' top-n lists into one order per group.

    Input columns: ``by``, ``model``, ``mo`` (model order), ``pos``, player,
    ``share``. For each position the next player is, among those not yet chosen,
    one with a majority of all models at that position; else one with a majority
    of the tie-break models; else the one with the largest share summed over all
    top-n lists. At one position at most one player can hold either majority, so
    the three rules are one fixed preference order, and only "not yet chosen" is
    sequential: a fold over at most ``n`` short arrays. Ties go to the player with
    more votes, then to the earlier model. A position whose players are all chosen
    already gives null.
    """
    ballots = top.where(F.col("pos") <= n)
    if by:
        # At most models x n rows per group: one shuffle on the group serves every step below.
        ballots = ballots.repartition(*by)
    total = F.sum(F.col("share").cast("decimal(18,3)")).over(Window.partitionBy(*by, player))
    votes = ballots.withColumn("__total", total).groupBy(*by, "pos", player).agg(
        F.count(F.lit(1)).alias("votes"),
        F.count_if(F.col("model").isin(list(tie_break))).alias("tie_votes"),
        F.coalesce(F.first("__total"), F.lit(0)).alias("total"), F.min("mo").alias("seen"))
    preference = F.struct(
        (F.col("votes") < majority).alias("a"), (F.col("tie_votes") < tie_majority).alias("b"),
        (-F.col("total")).alias("c"), (-F.col("votes")).alias("d"), F.col("seen"),
        F.col(player).alias("player"))
    lists = votes.groupBy(*by, "pos").agg(F.array_sort(F.collect_list(preference)).alias("prefs"))
    lists = lists.withColumn("prefs", F.transform("prefs", lambda p: p["player"]))
    by_pos = lists.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("pos", "prefs"))).alias("lists"))
    empty = F.array().cast(f"array<{top.schema[player].dataType.simpleString()}>")

    def choose(chosen: Column, at_pos: Column) -> Column:
        free = F.filter(at_pos["prefs"], lambda p: ~F.coalesce(F.array_contains(chosen, p), F.lit(False)))
        return F.concat(chosen, F.array(F.get(free, F.lit(0))))

    order = by_pos.select(*by, F.aggregate("lists", empty, choose).alias("chosen"))
    return order.select(*by, F.posexplode("chosen").alias("__i", player)).select(
        *by, (F.col("__i") + 1).cast("bigint").alias("final_rank"), F.col(player))


def rank_history(ranks: DataFrame, run: str, order: Sequence[Column], player: str) -> DataFrame:
    """Rank within every dated run, as ``Rank``, ``Predicted MVP Rank`` and ``Date``.

    A run holds one top-n list, so its window is small.
    """
    rank = F.row_number().over(Window.partitionBy(run).orderBy(*order)).cast("bigint")
    return ranks.select(rank.alias("Rank"), F.col(f"`{player}`").alias("Predicted MVP Rank"), F.col(run).alias("Date"))


def one_row_per_player(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key; all but one row per task and key go before the shuffle."""
    return top_n(df, keys, order, 1, "__keep").drop("__keep")
