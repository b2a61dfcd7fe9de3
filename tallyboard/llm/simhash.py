"""SimHash near-duplicates: pigeonhole blocks, Hamming check, connected components.

Documents become 64-bit fingerprints; equal fingerprints are one node from then on. Two
fingerprints that differ in at most ``max_bits`` bits agree in at least two of
``max_bits + 2`` blocks, so every close pair meets under some pair of blocks. A meeting
place with many fingerprints is divided again by the same argument on its remaining bits,
until it is small; no pair is lost and no place is capped. Each place emits links to the
smallest member of every local component, never all its pairs.

Defined results: null or blank text has fingerprint zero, linked like any other; repeated
rows stay repeated; a null doc_id is ignored as a representative unless nothing else is
there; other columns of the input play no part, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyboard.llm.common import broadcast_measured, col, fresh
from tallyboard.session import scratch_table

BITS = 64
SEED = 42

# A meeting place with more distinct fingerprints than this is divided further.
PLACE_SIZE = 1024

# Row numbers of one bitmap, as many as Spark's bitmap aggregate holds.
BITMAP_SHIFT = 15
BITMAP = 1 << BITMAP_SHIFT

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# Row i holds the bits of byte i, so that bit counts of many hashes are sums of table rows.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of word shingles, repeats included; bit set if set in over half the hashes."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    ends = ends[-n:] if n > 1 else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist())), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for k in range(8):
        byte = (hashes >> np.uint64(8 * k)).astype(np.uint8)
        ones[8 * k:8 * k + 8] = np.bincount(byte, minlength=256) @ _BYTE_BITS
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3, name: str = "fp") -> DataFrame:
    """The input with a bigint fingerprint column; whole texts, in Arrow batches."""

    @F.pandas_udf("bigint")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64), dtype="int64")

    return docs.withColumn(name, fp(col(text)))


def _spans(width: int, parts: int, start: int = 0) -> list[tuple[int, int]]:
    """Even division of bits [start, start + width) as (offset, length)."""
    cuts = [start + width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _mask(spans) -> int:
    return sum(((1 << length) - 1) << offset for offset, length in spans)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def meeting_places(nodes: DataFrame, max_bits: int, place_size: int = PLACE_SIZE) -> DataFrame:
    """Places (mask, key) of at least two distinct fingerprints; every close pair shares one.

    ``nodes`` has distinct ``fp``. A place is the set of fingerprints that agree on the
    bits of a mask. The first masks are pairs of blocks. A crowded place passes its members
    to places whose masks add one of ``max_bits + 1`` parts of the bits left free.
    """
    blocks = _spans(BITS, max_bits + 2)
    masks = sorted({_mask(pair) for pair in combinations(blocks, 2)})
    found = None
    members = nodes.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    while True:
        members = scratch_table(members.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))), "places")
        sizes = members.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
        sizes = scratch_table(sizes, "place_sizes")
        crowded = sizes.where(F.col("size") > place_size).select("mask").distinct()
        crowded = [r["mask"] & ((1 << BITS) - 1) for r in crowded.collect()]  # masks, a few by construction
        finer = {m: _finer(m, max_bits) for m in crowded}
        finer = {_signed(m): [_signed(x) for x in more] for m, more in finer.items() if more}
        divided = (F.col("size") > place_size) & F.col("mask").isin(list(finer))
        here = members.join(sizes.where(~divided), ["mask", "key"]).select("mask", "key", "fp")
        found = here if found is None else found.unionByName(here)
        if not finer:
            return found
        step = F.coalesce(*[F.when(F.col("mask") == m, F.array(*map(F.lit, more))) for m, more in finer.items()])
        members = (members.join(sizes.where(divided), ["mask", "key"])
                   .select("fp", F.explode(step).alias("mask")).distinct())


def _finer(mask: int, max_bits: int) -> list[int]:
    """Masks that add one part each of the free bits; none if too few bits are free.

    With at most ``max_bits`` differing bits among the free ones, one of the
    ``max_bits + 1`` parts is equal.
    """
    free = [i for i in range(BITS) if not mask >> i & 1]
    if len(free) <= 12:
        return []
    return [mask | sum(1 << free[i] for i in range(offset, offset + length))
            for offset, length in _spans(len(free), max_bits + 1)]


def _local_links(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member) of every component of close fingerprints in one place."""
    fps = np.sort(fps)
    bits = fps.view(np.uint64)
    left = np.ones(len(fps), bool)
    a, b = [], []
    for i in range(len(fps)):
        if not left[i]:
            continue
        left[i] = False
        todo = [i]
        while todo:
            near = np.flatnonzero(left & (np.bitwise_count(bits ^ bits[todo.pop()]) <= max_bits))
            left[near] = False
            todo.extend(near.tolist())
            a.extend(fps[near].tolist())
            b.extend([int(fps[i])] * len(near))
    return np.array(a, np.int64), np.array(b, np.int64)


def close_links(nodes: DataFrame, max_bits: int, place_size: int = PLACE_SIZE) -> DataFrame:
    """Links (u, v), u > v, that connect exactly the fingerprints joined by chains of close pairs."""
    places = meeting_places(nodes, max_bits, place_size)
    gathered = places.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).select("fps")

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for fps in batch["fps"]:
                u, v = _local_links(np.asarray(fps, np.int64), max_bits)
                if len(u):
                    yield pd.DataFrame({"u": u, "v": v})

    return gathered.mapInPandas(link, "u bigint, v bigint").distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, root) for every linked node: root is the smallest node reachable.

    Alternating large-star and small-star rounds. Each round is two pairs of a map-side
    combined minimum and a join; hubs are joined with one row, which run-time
    planning can split. The links of each round are a written table.
    """
    now = scratch_table(links.select("u", "v"), "links")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = scratch_table(large, "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = (large.join(least, "u").select(F.explode(pairs).alias("e")).select("e.u", "e.v")
                 .where(F.col("u") != F.col("v")).distinct())
        now = scratch_table(small, "small_star")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select("u", F.col("v").alias("root"))
        mark = seen


def roots(nodes: DataFrame, max_bits: int = 2, place_size: int = PLACE_SIZE) -> DataFrame:
    """(fp, root) for every distinct ``fp``: root is the smallest fingerprint of its class."""
    linked = components(close_links(nodes.select("fp"), max_bits, place_size)).withColumnRenamed("u", "fp")
    return nodes.select("fp").join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
            max_bits: int = 2, place_size: int = PLACE_SIZE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links, the document's own included.
    """
    light = with_fingerprint(docs.select(col(id_col).alias("doc_id"), col(text).alias("text")), "text", shingle)
    light = scratch_table(light.select("doc_id", "fp"), "fingerprints")
    nodes = scratch_table(light.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "nodes")
    linked = scratch_table(components(close_links(nodes.select("fp"), max_bits, place_size)).select(F.col("u").alias("fp"), "root"), "linked")
    # Classes of several fingerprints, their roots included.
    rooted = linked.unionByName(linked.select(F.col("root").alias("fp"), "root").distinct())
    rooted = scratch_table(nodes.join(broadcast_measured(rooted, 16), "fp").select("fp", "root", "least"), "roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id")
    # Copies of a fingerprint without links; every other document is its own class.
    copies = nodes.where("n > 1").join(rooted.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    labels = scratch_table(labels.unionByName(copies), "labels")
    return light.join(broadcast_measured(labels, 24), "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id"))


def numbered_rows(rows: DataFrame, staying: DataFrame, number: str) -> DataFrame:
    """Rows whose ``number`` is among the numbers of ``staying`` (column of the same name; distinct, none negative).

    Numbers that are dense, as those of one table's partitions, become bitmaps of 4 KiB for
    32,768 of them. If all bitmaps are within the library's bound they are broadcast and no
    row moves; beyond it both sides are shuffled by number.
    """
    bucket, bits, bit = fresh("bucket"), fresh("bits"), F.col(number).bitwiseAND(F.lit(BITMAP - 1))
    maps = staying.groupBy(F.shiftright(number, BITMAP_SHIFT).alias(bucket)).agg(F.bitmap_construct_agg(bit).alias(bits))
    maps = scratch_table(maps, "staying_bits")
    small = broadcast_measured(maps, BITMAP // 8 + 16)
    if small is maps:
        return rows.join(staying, number, "left_semi")
    byte = F.conv(F.hex(F.substring(F.col(bits), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.join(small, F.shiftright(number, BITMAP_SHIFT) == F.col(bucket)).where(
        F.bit_get(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1).drop(bucket, bits)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
             max_bits: int = 2, place_size: int = PLACE_SIZE) -> DataFrame:
    """The input without near duplicates: of each class the row with the smallest doc_id stays.

    Exactly one row of a class stays, also when doc_ids repeat or are null (null last).
    Columns and their order are as in the input.
    """
    fp, number = fresh("fp"), fresh("row")
    numbered = with_fingerprint(docs, text, shingle, fp).withColumn(number, F.monotonically_increasing_id())
    numbered = scratch_table(numbered, "numbered")
    order = F.struct(col(id_col).isNull().alias("unnamed"), col(id_col).alias("id"), F.col(number).alias("row"))
    nodes = scratch_table(numbered.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("first")), "nodes")
    staying = (nodes.join(roots(nodes, max_bits, place_size), "fp").groupBy("root")
               .agg(F.min("first").alias("first")).select(F.col("first.row").alias(number)))
    return numbered_rows(numbered, scratch_table(staying, "staying"), number).select(*map(col, docs.columns))
