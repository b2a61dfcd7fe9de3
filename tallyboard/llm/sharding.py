"""Sharding by proportional stratified interleaving, in DataFrame operations alone.

Rows of each source are shuffled by a seeded hash and ranked. A row's fractional rank is
its rank over the size of its source; sorted by it, all sources run through the order
evenly, so every cut of the order has the sources in the proportions of the whole. The
order is cut into shards whose row counts differ by one at most.

Ranks over any number of rows come from range partitions: rows are numbered inside their
partition, and a table with one row per partition and source says where each begins. No
task holds a source, and no row is sent to the driver.

Defined results: null text has no bytes and checksum 0; rows without a source are a source
of their own; rows that repeat in all sort keys take neighbouring places, which of them
takes which makes no difference; an empty table gives an empty result; other columns play
no part, whatever their names, unless they are kept by request.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyboard.llm.common import broadcast_measured, col, fresh
from tallyboard.session import scratch_table

OVERHEAD = 16  # bytes that a row takes besides its text
_PARTITION_BITS = 33  # monotonically_increasing_id puts the partition number above this bit


def _numbered(rows: DataFrame, order: Sequence[Column], row: str, part: str, name: str) -> DataFrame:
    """Rows in range partitions of an order, written with partition and number inside it."""
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(row, F.monotonically_increasing_id())
    return scratch_table(laid.withColumn(part, F.shiftright(F.col(row), _PARTITION_BITS)), name)


def shuffle_key(seed: int, id_col: str, text: str) -> Column:
    """60 bits of a digest of seed, id and text: the seeded shuffle."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), col(id_col).cast("string"), col(text)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text: str = "text", source: str = "source",
           keep: Sequence[str] = (), seed: int = 1) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, and columns to ``keep``.

    Shards are 0 to ``shards`` - 1, slots of a shard 0, 1, 2 and so on.
    """
    own = {k: fresh(k) for k in ("source", "key", "row", "part", "first", "before", "n", "rank", "share", "run", "of")}
    c = {k: F.col(v) for k, v in own.items()}
    whole = F.coalesce(col(text), F.lit(""))
    out = [col(id_col).alias("doc_id"), (F.octet_length(whole) + OVERHEAD).cast("bigint").alias("size"),
           F.crc32(whole).alias("text_crc32")]
    rows = scratch_table(docs.select(*[col(k) for k in keep if k not in ("doc_id", "size", "text_crc32", "shard", "slot")], *out,
                                     col(source).cast("string").alias(own["source"]),
                                     shuffle_key(seed, id_col, text).alias(own["key"])), "sharded")
    ties = [c["key"], F.col("doc_id"), F.col("text_crc32"), F.col("size"), c["source"]]
    rows = _numbered(rows, [c["source"], *ties[:-1]], own["row"], own["part"], "by_source")
    runs = rows.groupBy(c["source"].alias(own["of"]), c["part"].alias(own["run"])).agg(
        F.min(c["row"]).alias(own["first"]), F.count(F.lit(1)).alias(own["n"]))
    of_source = Window.partitionBy(c["of"])
    earlier = of_source.orderBy(c["run"]).rowsBetween(Window.unboundedPreceding, -1)
    runs = scratch_table(runs.select(c["of"], c["run"], c["first"], F.coalesce(F.sum(c["n"]).over(earlier), F.lit(0)).alias(own["before"]),
                                     F.sum(c["n"]).over(of_source).alias(own["n"])), "source_runs")
    rows = rows.join(broadcast_measured(runs, 64), (c["part"] == c["run"]) & c["source"].eqNullSafe(c["of"]))
    rank = c["row"] - c["first"] + c["before"]
    rows = rows.withColumn(own["share"], (rank + F.lit(0.5)) / c["n"]).drop(*[own[k] for k in ("row", "part", "of", "run", "first", "before", "n")])
    rows = _numbered(rows, [c["share"], *ties], own["row"], own["part"], "by_share")
    runs = rows.groupBy(c["part"].alias(own["run"])).agg(F.min(c["row"]).alias(own["first"]), F.count(F.lit(1)).alias(own["n"]))
    # One row per partition, far fewer than rows.
    every = Window.orderBy(c["run"]).rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy(F.lit(1))
    runs = scratch_table(runs.select(c["run"], c["first"], F.coalesce(F.sum(c["n"]).over(every), F.lit(0)).alias(own["before"]),
                                     F.sum(c["n"]).over(total).alias(own["n"])), "share_runs")
    place = c["row"] - c["first"] + c["before"]
    rows = rows.join(broadcast_measured(runs, 32), c["part"] == c["run"]).withColumn(own["rank"], place)
    shard = F.call_function("div", c["rank"] * F.lit(shards), c["n"])
    begin = F.call_function("div", shard * c["n"] + F.lit(shards - 1), F.lit(shards).cast("bigint"))
    return rows.select(*[col(k) for k in rows.columns if k not in own.values()],
                       shard.cast("int").alias("shard"), (c["rank"] - begin).alias("slot"))
