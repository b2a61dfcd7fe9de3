"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source gets a target of words. A seeded hash puts the rows of a source in a permuted
order, a number line; rows that repeat id and text are numbered, and each has a place of its
own. The mix takes whole passes over the line and then its beginning, up to a cut that
counts of ever finer intervals find; rows after the cut are added while they fit, so that
the words taken miss the target by less than a row.

The line is divided into blocks of about equal words. Passes times blocks are a source's
quota of draws. A tree splits the quotas of all sources exactly among the output shards:
each node deals its draws to its two halves by a multivariate hypergeometric draw. Shards
then draw disjoint runs of each source's permuted blocks and shuffle their rows.

Only per-source figures and the table of draws (shards times blocks of a shard, both
parameters) are on the driver. Everything is seeded: reruns agree.

Defined results: null text has no words; rows without a source are a source of their own,
the last; rows that repeat id and text are rows like others, which of them is taken how
often follows their other columns; an empty table gives an empty mix; columns of any other
name pass through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyboard.llm.common import broadcast_measured, col, fresh, word_count
from tallyboard.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS
from tallyboard.operators.ranking import rank_all
from tallyboard.session import scratch_table

LEAST_SHARDS = 64
SHARD_WORDS = 32_000_000  # so many words make one more shard
BLOCKS_PER_SHARD = 64
MOST_BLOCKS = 1 << 18  # of all shards together, if there are fewer shards than that
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)
LINE_BITS = 60
FAN = 64  # intervals that one count divides an interval into
POOL_ROWS = 4_096  # rows after the cut that are tried one by one, at most (rows with equal hash count as one)
PIECE = 1 << 14  # numbers of repeated rows that one task makes at a time
GROUP_ROWS = 4_096  # repeated rows that one task numbers


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = MOST_REPEATS) -> list[float]:
    """Shares of the whole by weight, none above ``most`` times its size; the excess is shared again by weight."""
    open_, out, left = [i for i, s in enumerate(sizes) if s], [0.0] * len(sizes), float(sum(sizes))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        above = [i for i in open_ if unit * weights[i] >= most * sizes[i]]
        if not above:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in above:
            out[i] = float(most * sizes[i])
            left -= out[i]
        done = set(above)
        open_ = [i for i in open_ if i not in done]
    return out


@dataclass
class Weighed:
    """(source, place, words) of every row; (group, n) of rows that repeat, if there are any."""

    rows: DataFrame
    repeated: DataFrame | None = None
    most: int = 1  # rows of the largest group


@dataclass
class Plan:
    """Per source: name, words, target, whole passes, cut, rows chosen after it, blocks; the shard of each draw; shards."""

    sources: pd.DataFrame
    draws: pd.DataFrame
    shards: int
    weighed: Weighed | None = None


def _group(id_col: str, text: str, source: str, seed: int) -> Column:
    """What rows that repeat source, id and text have in common; others may meet by chance, which does no harm."""
    return F.xxhash64(F.lit(seed), col(id_col), col(text), col(source).cast("string"))


def _line(id_col: str, text: str, seed: int, number: Column, group: Column) -> Column:
    """Place of a row on the number line of its source; ``number`` tells rows of a group apart, from 0."""
    first = F.xxhash64(F.lit(seed), col(id_col), col(text))
    return F.pmod(F.when(number == 0, first).otherwise(F.xxhash64(group, number)), F.lit(1 << LINE_BITS))


def _measured_frame(spark: SparkSession, rows: pd.DataFrame, schema: str) -> DataFrame:
    """Driver-made rows as a table to join with: broadcast within the library's bounds."""
    df = spark.createDataFrame([tuple(r) for r in rows.itertuples(index=False)], schema)
    size = 40 * rows.size + sum(8 * rows[c].map(lambda v: len(v) if isinstance(v, (list, str)) else 0).sum() for c in rows.columns[rows.dtypes == object])
    return F.broadcast(df) if len(rows) <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def weigh(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = 1) -> Weighed:
    """Source, place and words of every row, written once; texts stay where they are.

    Rows of a group are counted where they are read. Their places are those of numbers from
    0, made in pieces, so that they do not depend on how the rows lie.
    """
    group = _group(id_col, text, source, seed)
    rows = docs.select(col(source).cast("string").alias("source"), group.alias("group"), word_count(col(text)).alias("words"),
                       _line(id_col, text, seed, F.lit(0), group).alias("place"))
    groups = scratch_table(rows.groupBy("source", "group").agg(
        F.count(F.lit(1)).alias("n"), F.max("words").alias("words"), F.min("place").alias("place")), "weighed")
    most = groups.agg(F.max("n")).first()[0] or 0
    first = groups.select("source", "place", "words")
    if most < 2:
        return Weighed(first)
    repeated = groups.where("n > 1")
    pieces = repeated.select("source", "group", "words", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / PIECE))).alias("piece"))
    if most > PIECE:
        pieces = pieces.repartition("group", "piece")
    begin = F.greatest(F.lit(1), F.col("piece") * PIECE)
    last = F.least(F.col("n"), (F.col("piece") + 1) * PIECE) - 1
    numbers = pieces.where(begin <= last).select("source", "group", "words", F.explode(F.sequence(begin, last)).alias("number"))
    more = numbers.select("source", F.pmod(F.xxhash64("group", "number"), F.lit(1 << LINE_BITS)).alias("place"), "words")
    return Weighed(scratch_table(first.unionByName(more), "places"), repeated.select("group", "n"), most)


def numbered(docs: DataFrame, weighed: Weighed | None, name: str, group: Column) -> DataFrame:
    """The input with the number of each row in its group, from 0; only rows that repeat move.

    They are numbered in the order of all their columns, across tasks where a group is large.
    """
    if weighed is None or weighed.repeated is None:
        return docs.withColumn(name, F.lit(0).cast("bigint"))
    own, order, rank = fresh("group"), fresh("order"), fresh("rank")
    known = broadcast_measured(weighed.repeated.select(F.col("group").alias(own)), 8)
    keyed = docs.withColumn(name, group)
    again = keyed.join(known, F.col(name) == F.col(own), "left_semi")
    # Rows equal in all columns are one like the other: where they lie tells them apart.
    again = again.withColumn(order, F.xxhash64(*map(col, docs.columns)))
    last = fresh("place")
    ranked = rank_all(again.withColumn(last, F.monotonically_increasing_id()), [name], [F.col(order), F.col(last)], rank, GROUP_ROWS, weighed.most)
    return keyed.join(known, F.col(name) == F.col(own), "left_anti").select(*map(col, docs.columns), F.lit(0).cast("bigint").alias(name)).unionByName(
        ranked.select(*map(col, docs.columns), (F.col(rank) - 1).alias(name)))


def _open_parts(light: DataFrame, open_: pd.DataFrame) -> pd.DataFrame:
    """Of each source's open interval [lo, lo + width) in FAN parts: words of the parts that fit, the first part that does not, its rows, and the last of the pool.

    One row a source reaches the driver.
    """
    wanted = _measured_frame(light.sparkSession, open_[["source", "number", "lo", "width", "left"]],
                             "s string, number int, lo bigint, width bigint, left double")
    part = F.call_function("div", F.col("place") - F.col("lo"), F.greatest(F.lit(1), F.call_function(
        "div", F.col("width"), F.lit(FAN).cast("bigint"))))
    inside = (light.join(wanted, F.col("source").eqNullSafe(F.col("s")))
              .where((F.col("place") >= F.col("lo")) & (F.col("place") - F.col("lo") < F.col("width"))))
    parts = inside.groupBy("number", "left", part.alias("part")).agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("rows"))
    upto = Window.partitionBy("number").orderBy("part")  # at most FAN rows a source
    parts = parts.withColumn("sum", F.sum("words").over(upto))
    parts = parts.withColumn("fits", F.col("sum") <= F.col("left"))
    parts = parts.withColumn("behind", F.sum(F.when(~F.col("fits"), F.col("rows"))).over(upto))
    first = F.min(F.when(~F.col("fits"), F.struct("part", "rows")))
    return parts.groupBy("number").agg(
        F.coalesce(F.max(F.when(F.col("fits"), F.col("sum"))), F.lit(0)).alias("full"), first["part"].alias("first"), first["rows"].alias("first_rows"),
        F.max(F.when(~F.col("fits") & (F.col("behind") <= POOL_ROWS), F.col("part"))).alias("last"),
        F.max(F.when(~F.col("fits"), F.col("part"))).alias("end")).toPandas()


def _cuts(light: DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Adds cut, words left at the cut, and end of the pool behind it to every source."""
    sources = sources.set_index("number", drop=False)
    sources = sources.assign(lo=0, width=1 << LINE_BITS, left=(sources["target"] - sources["passes"] * sources["words"]).astype(float), cut=0, pool_end=0)
    open_ = sources[sources["left"] > 0]
    while len(open_):
        found = _open_parts(light, open_).set_index("number")
        lo, width, left = (open_[c] for c in ("lo", "width", "left"))
        step = np.maximum(1, width // FAN)
        found = found.reindex(open_.index)  # a source without a row in its interval has no figures
        left = left - found["full"].fillna(0)
        whole = found["first"].isna()  # everything open fits
        first = found["first"].fillna(0).astype(np.int64)
        cut = np.where(whole, lo + width, lo + first * step)
        going = ~whole & (found["first_rows"].fillna(0) > POOL_ROWS) & (step > 1)
        last = found["last"].fillna(found["first"]).fillna(0).astype(np.int64)
        pool_end = np.where(whole | (last == found["end"]), lo + width, lo + (last + 1) * step)
        sources.loc[open_.index, "left"] = left
        sources.loc[open_.index, "cut"] = cut
        sources.loc[open_.index, "pool_end"] = pool_end
        sources.loc[open_.index, "lo"] = cut
        sources.loc[open_.index, "width"] = step
        open_ = sources.loc[open_.index[going]]
    return sources.reset_index(drop=True)


def _fit(pool: Column, left: Column) -> Column:
    """Places to add behind the cut: in order, each that fits; last, one that is too large if that comes nearer."""
    start = F.struct(left.cast("double").alias("left"), F.array().cast("array<bigint>").alias("taken"),
                     F.lit(None).cast("bigint").alias("spare"), F.lit(None).cast("bigint").alias("spare_words"))

    def step(s: Column, r: Column) -> Column:
        fits = r["words"] <= s["left"]
        nearer = ~fits & (s["spare_words"].isNull() | (r["words"] < s["spare_words"]))
        return F.struct(F.when(fits, s["left"] - r["words"]).otherwise(s["left"]).alias("left"),
                        F.when(fits, F.concat(s["taken"], F.array(r["place"]))).otherwise(s["taken"]).alias("taken"),
                        F.when(nearer, r["place"]).otherwise(s["spare"]).alias("spare"),
                        F.when(nearer, r["words"]).otherwise(s["spare_words"]).alias("spare_words"))
    return F.aggregate(pool, start, step, lambda s: F.when(
        s["spare_words"] - s["left"] < s["left"], F.concat(s["taken"], F.array(s["spare"]))).otherwise(s["taken"]))


def _chosen(light: DataFrame, sources: pd.DataFrame) -> dict[int, list[int]]:
    pools = sources[sources["pool_end"] > sources["cut"]]
    if not len(pools):
        return {}
    wanted = _measured_frame(light.sparkSession, pools[["source", "number", "cut", "pool_end", "left"]],
                             "s string, number int, cut bigint, pool_end bigint, left double")
    behind = light.join(wanted, F.col("source").eqNullSafe(F.col("s"))).where(F.col("place").between(F.col("cut"), F.col("pool_end") - 1))
    # Rows of equal place are one, so a pool has at most POOL_ROWS rows; those without words would add nothing.
    pooled = behind.groupBy("number", "left", "place").agg(F.sum("words").alias("words")).where("words > 0")
    pool = F.array_sort(F.collect_list(F.struct("place", "words")))
    found = pooled.groupBy("number", "left").agg(pool.alias("pool")).select("number", _fit(F.col("pool"), F.col("left")).alias("places"))
    return {r["number"]: sorted(r["places"]) for r in found.where(F.size("places") > 0).collect()}


def split(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources) quotas: a tree of multivariate hypergeometric draws, exact in every column.

    Shards get equal numbers of draws, give or take one.
    """
    if shards == 1:
        return quotas[None]
    half = shards // 2
    left = int(quotas.sum()) * half // shards
    drawn = rng.multivariate_hypergeometric(quotas, left, method="marginals")
    return np.concatenate([split(drawn, half, rng), split(quotas - drawn, shards - half, rng)])


def make_plan(weighed: Weighed, shards: int | None = None, blocks_per_shard: int = BLOCKS_PER_SHARD,
              weights: Sequence[float] = WEIGHTS, most: float = MOST_REPEATS, seed: int = 1) -> Plan:
    """Targets, cuts and draws for the rows that were weighed.

    Unless it is given, the number of shards grows with the words, and a shard's blocks
    become fewer as shards become very many, so that the table of draws stays moderate.
    """
    light = weighed.rows
    stats = light.groupBy("source").agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("rows")).collect()
    stats = sorted(stats, key=lambda r: (r["source"] is None, r["source"]))  # one row per source, by code points
    sizes = [r["words"] for r in stats]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(stats))], most)
    sources = pd.DataFrame({"source": [r["source"] for r in stats], "number": np.arange(len(stats)), "words": sizes,
                            "target": goal, "passes": [int(t // s) if s else 0 for t, s in zip(goal, sizes)]})
    sources["source"] = sources["source"].astype(object)
    shards = shards or max(LEAST_SHARDS, -(-sum(sizes) // SHARD_WORDS))
    blocks_per_shard = max(1, min(blocks_per_shard, MOST_BLOCKS // shards))
    if not len(sources):
        return Plan(sources.assign(cut=0, chosen=None, blocks=1), pd.DataFrame({"number": [], "block": [], "shards": []}), shards, weighed)
    sources = _cuts(light, sources)
    chosen = _chosen(light, sources)
    sources["chosen"] = [chosen.get(n, []) for n in sources["number"]]
    block_words = max(1.0, sum(goal) / (shards * blocks_per_shard))
    sources["blocks"] = [max(1, round(w / block_words)) for w in sizes]
    # Blocks of the last, partial pass: up to the one that holds the last place taken.
    ends = [max([0, int(s.cut), *[p + 1 for p in s.chosen]]) for s in sources.itertuples()]
    partial = [-(-e * b >> LINE_BITS) if e else 0 for e, b in zip(ends, sources["blocks"])]
    quotas = np.array([s.passes * s.blocks + p for s, p in zip(sources.itertuples(), partial)], np.int64)
    rng = np.random.default_rng(seed)
    dealt = split(quotas, shards, rng)
    rows = []
    for s, quota, extra in zip(sources.itertuples(), quotas.tolist(), partial):
        shard_of = np.empty(quota, np.int64)
        shard_of[rng.permutation(quota)] = np.repeat(np.arange(shards), dealt[:, s.number])
        for block in range(s.blocks):
            mine = shard_of[block::s.blocks] if s.passes else shard_of[block:block + 1]
            rows.append((s.number, block, [int(x) for x in mine]))
    return Plan(sources, pd.DataFrame(rows, columns=["number", "block", "shards"]), shards, weighed)


def place(docs: DataFrame, plan: Plan, name: str, id_col: str = "doc_id", text: str = "text", source: str = "source",
          seed: int = 1) -> DataFrame:
    """The input with struct ``name``: the shard of each copy that the mix takes, source words and target."""
    spark = docs.sparkSession
    own = {k: fresh(k) for k in ("s", "number", "words", "target", "passes", "cut", "chosen", "blocks", "n", "b", "shards", "place", "block")}
    c = {k: F.col(v) for k, v in own.items()}
    sources = plan.sources[["source", "number", "words", "target", "passes", "cut", "chosen", "blocks"]]
    sources = _measured_frame(spark, sources, f"{own['s']} string, {own['number']} int, {own['words']} bigint, {own['target']} double, "
                              f"{own['passes']} int, {own['cut']} bigint, {own['chosen']} array<bigint>, {own['blocks']} bigint")
    draws = _measured_frame(spark, plan.draws, f"{own['n']} int, {own['b']} bigint, {own['shards']} array<int>")
    group = _group(id_col, text, source, seed)
    own["k"] = fresh("k")
    found = numbered(docs, plan.weighed, own["k"], group).withColumn(own["place"], _line(id_col, text, seed, F.col(own["k"]), group)).join(
        sources, col(source).cast("string").eqNullSafe(c["s"]))
    # Whole arithmetic on 128-bit decimals: a place times a number of blocks exceeds a bigint.
    block = F.floor(c["place"].cast("decimal(19,0)") * c["blocks"].cast("decimal(10,0)") / F.lit(1 << LINE_BITS).cast("decimal(19,0)"))
    found = found.withColumn(own["block"], F.least(block.cast("bigint"), c["blocks"] - 1)).join(
        draws, (c["number"] == c["n"]) & (c["block"] == c["b"]))
    copies = c["passes"] + ((c["place"] < c["cut"]) | F.array_contains(c["chosen"], c["place"])).cast("int")
    return found.select(*map(col, docs.columns), F.struct(
        F.slice(c["shards"], F.lit(1), copies).alias("shards"), c["words"].alias("source_size"),
        c["target"].alias("target")).alias(name))


def mix(docs: DataFrame, plan: Plan, shard: str | None = None, id_col: str = "doc_id",
        text: str = "text", source: str = "source", seed: int = 1) -> DataFrame:
    """One row per copy, one partition per shard, shuffled inside by a seeded hash.

    Columns are those of the input; ``shard`` names a further one for the shard's number
    (an input column of that name is replaced).
    """
    mark, copy = fresh("mark"), fresh("copy")
    own = shard or fresh("shard")
    rows = place(docs, plan, mark, id_col, text, source, seed)
    rows = rows.select(*[col(k) for k in docs.columns if k != shard], F.posexplode(F.col(f"{mark}.shards")).alias(copy, own))
    rows = rows.repartitionById(plan.shards, F.col(own)).sortWithinPartitions(
        F.xxhash64(F.lit(seed + 1), F.col(copy), col(id_col), col(text)))
    return rows.drop(copy) if shard else rows.drop(copy, own)


def counted(docs: DataFrame, plan: Plan, mixture: DataFrame, name: str, id_col: str = "doc_id", text: str = "text",
            source: str = "source", seed: int = 1) -> DataFrame:
    """The input, less its text, with struct ``name``: copies of the row in ``mixture``, rows that ``mix`` gave; source words and target.

    Rows that repeat id, text and source share their copies as evenly as whole copies allow.
    """
    own = {k: fresh(k) for k in ("id", "s", "hash", "group", "k", "i", "t", "h", "rows", "copies", "source", "words", "target")}
    c = {k: F.col(v) for k, v in own.items()}

    def keyed(rows: DataFrame, names: Sequence[str], *more: Column) -> DataFrame:
        key = col(id_col), col(source).cast("string"), F.xxhash64(col(text))
        return rows.select(*more, *[k.alias(own[n]) for k, n in zip(key, names)])

    def counts(rows: DataFrame, is_copy: int) -> DataFrame:
        return keyed(rows, ("i", "t", "h"), F.lit(1 - is_copy).alias(own["rows"]), F.lit(is_copy).alias(own["copies"]))

    found = counts(docs, 0).unionByName(counts(mixture, 1)).groupBy(c["i"], c["t"], c["h"]).agg(
        F.sum(c["rows"]).alias(own["rows"]), F.sum(c["copies"]).alias(own["copies"])).where(c["copies"] > 0)
    sources = _measured_frame(docs.sparkSession, plan.sources[["source", "words", "target"]],
                              f"{own['source']} string, {own['words']} bigint, {own['target']} double")
    kept = [col(k) for k in docs.columns if k != text]
    narrow = keyed(docs, ("id", "s", "hash"), *kept, _group(id_col, text, source, seed).alias(own["group"]))
    both = numbered(narrow, plan.weighed, own["k"], c["group"]).join(sources, c["s"].eqNullSafe(c["source"])).join(
        found, c["id"].eqNullSafe(c["i"]) & c["s"].eqNullSafe(c["t"]) & (c["hash"] == c["h"]), "left")
    whole = F.call_function("div", c["copies"], c["rows"]) + (c["k"] < c["copies"] % c["rows"]).cast("int")
    copies = F.coalesce(whole, F.lit(0)).cast("bigint")
    return both.select(*kept, F.struct(copies.alias("copies"), c["words"].alias("source_size"), c["target"].alias("target")).alias(name))
