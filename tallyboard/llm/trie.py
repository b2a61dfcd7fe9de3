"""Conversation prefix trie from vertical bitmaps.

A node is a distinct sequence of first turns. Conversations lie in shards: consecutive ids,
of a bounded number of conversations and turns. A shard indexes (position, turn) to the set
of its conversations that say this turn there, as a bitmap. From the root down, the bitmap
of a node is intersected with the postings of the next position: each gives a child, its
population count the child's members, the conversations that have no next turn the child's
end list. Shards are independent; their nodes are named by a digest of their turns, so
counts of equal nodes are added map-side, and end lists of shards follow one another in the
order of ids.

Sums over subtrees concern only nodes of two conversations or more, as others have one leaf
and save nothing. They come from pointer doubling: in round k every node adds the sum of 2^k
levels to its ancestor 2^k levels up, so rounds grow with the logarithm of the depth.

Defined results: null role or text is empty text; null turns come first, and turns that tie
stand by role, then text; repeated rows are repeated turns; rows without a conversation id
take no part; other columns play no part, whatever their names; an empty table gives no
node. A turn is known by a digest of 128 bits, its text leaves the first shuffle as such. A
conversation longer than a shard is streamed as a shard of its own.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyboard.llm.common import col
from tallyboard.operators.ranking import rank_all
from tallyboard.session import scratch_table

SHARD_CONVERSATIONS = 1_024
SHARD_TURNS = 1 << 16
ROOT = bytes(16)
OUT_ROWS = 1 << 14  # nodes that a task hands over at once

_NODES = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                    ("n_convs", pa.int64()), ("bytes", pa.int64()), ("ends", pa.list_(pa.int64()))])


def turn_digests(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """(conv_id, position, said, bytes) of every turn: place from 1, digest of role and text, UTF-8 bytes of the text."""
    rows = turns.select(col(conversation).cast("bigint").alias("conv_id"), col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"),
                        F.coalesce(col(text), F.lit("")).alias("text")).where(F.col("conv_id").isNotNull())
    placed = rank_all(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "position")
    said = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    return placed.select("conv_id", "position", F.substring(F.unhex(F.sha2(said, 256)), 1, 16).alias("said"),
                         F.octet_length("text").cast("bigint").alias("bytes"))


def shared_openings(light: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Conversations rebuilt on the opening of their group's first one.

    Conversation c takes the first crc32(c) % ``most`` turns of conversation c - c % ``group``,
    all if that has fewer, and after them its own turns behind as many. A row at position 0
    says of each conversation that it exists, also if it is left without a turn.
    """
    own = light.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    own = scratch_table(own, "conversations")
    bases = own.where(F.col("conv_id") == F.col("base")).select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    own = own.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    kept = light.join(own.select("conv_id", "h", "taken"), "conv_id").where(F.col("position") > F.col("h")).select(
        "conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "said", "bytes")
    opening = light.where((F.col("conv_id") % group == 0) & (F.col("position") < most)).withColumnRenamed("conv_id", "base")
    taken = opening.join(own.select("base", "conv_id", "h"), "base").where(F.col("position") <= F.col("h")).select(
        "conv_id", "position", "said", "bytes")
    there = own.select("conv_id", F.lit(0).cast("bigint").alias("position"), F.lit(None).cast("binary").alias("said"),
                       F.lit(0).cast("bigint").alias("bytes"))
    return there.unionByName(kept).unionByName(taken)


def _child(node: bytes, said: bytes) -> bytes:
    return hashlib.sha256(node + said).digest()[:16]


def shard_nodes(ids: list[int], turns: list[list[tuple[bytes, int]]]) -> Iterator[tuple]:
    """Nodes of one shard, depth first: node, parent, depth, smallest id, members, bytes of the last text, ids that end here.

    ``ids`` ascend; ``turns`` are the (digest, bytes) of each conversation.
    """
    postings: dict[tuple[int, bytes], int] = defaultdict(int)
    ended: dict[int, int] = defaultdict(int)
    for i, said in enumerate(turns):
        bit = 1 << i
        for depth, (digest, _) in enumerate(said):
            postings[depth, digest] |= bit
        ended[len(said)] |= bit
    todo = [((1 << len(ids)) - 1, 0, ROOT, None, 0)]
    while todo:
        members, depth, node, parent, size = todo.pop()
        least = (members & -members).bit_length() - 1
        here = members & ended.get(depth, 0)
        ends, rest = [], here
        while rest:
            low = rest & -rest
            ends.append(ids[low.bit_length() - 1])
            rest ^= low
        yield node, parent, depth, ids[least], members.bit_count(), size, ends
        rest = members ^ here
        while rest:
            digest, size = turns[(rest & -rest).bit_length() - 1][depth]
            child = members & postings[depth, digest]
            rest &= ~child
            todo.append((child, depth + 1, _child(node, digest), node, size))


class _Chain:
    """Nodes of one conversation, turn after turn."""

    def __init__(self, conversation: int):
        self.id, self.last = conversation, (ROOT, None, 0, 0)

    def add(self, said: bytes, size: int) -> tuple:
        node, parent, depth, before = self.last
        self.last = _child(node, said), node, depth + 1, size
        return node, parent, depth, self.id, 1, before, []

    def end(self) -> tuple:
        node, parent, depth, size = self.last
        return node, parent, depth, self.id, 1, size, [self.id]


def _local(batches: Iterator[pa.RecordBatch], conversations: int, most_turns: int) -> Iterator[tuple]:
    """Nodes of the shards of a partition that is sorted by conversation and position."""
    ids: list[int] = []
    turns: list[list[tuple[bytes, int]]] = []
    held, chain = 0, None
    for batch in batches:
        for c, said, size in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "said", "bytes"))):
            if chain and c != chain.id:
                yield chain.end()
                chain = None
            if chain:
                if said is not None:
                    yield chain.add(said, size)
                continue
            if not ids or ids[-1] != c:
                if len(ids) >= conversations or held >= most_turns:
                    yield from shard_nodes(ids, turns)
                    ids, turns, held = [], [], 0
                ids.append(c)
                turns.append([])
            if said is not None:
                turns[-1].append((said, size))
                held += 1
            if len(turns[-1]) >= most_turns:
                # Those before it are a shard; this one goes on by itself.
                if len(ids) > 1:
                    yield from shard_nodes(ids[:-1], turns[:-1])
                chain = _Chain(c)
                for t in turns[-1]:
                    yield chain.add(*t)
                ids, turns, held = [], [], 0
    if chain:
        yield chain.end()
    if ids:
        yield from shard_nodes(ids, turns)


def _frames(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) >= OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def local_nodes(light: DataFrame, conversations: int = SHARD_CONVERSATIONS, turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of every shard: node, parent, depth, conv_id, n_convs, bytes, ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _frames(_local(batches, conversations, turns), _NODES)

    # A range holds whole conversations, and its shards are runs of ids that no other shard reaches into.
    ordered = light.select("conv_id", "position", "said", "bytes").repartitionByRange("conv_id").sortWithinPartitions("conv_id", "position")
    return ordered.mapInArrow(run, "node binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, bytes bigint, ends array<bigint>")


def end_digests(local: DataFrame) -> DataFrame:
    """(node, ends_sha256) of nodes where conversations end: their ids in order, joined by commas.

    Lists of shards are streamed one after the other; a task holds one of them.
    """
    rows = local.where(F.size("ends") > 0).select("node", "ends").withColumn("first", F.col("ends")[0])
    rows = rows.repartition("node").sortWithinPartitions("node", "first").select("node", "ends")
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, digest = None, None
        for batch in batches:
            for node, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if node != now:
                    if now is not None:
                        yield now, digest.hexdigest()
                    now, digest = node, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(map(str, ends)).encode())
        if now is not None:
            yield now, digest.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _frames(hashed(batches), schema)

    return rows.mapInArrow(run, "node binary, ends_sha256 string")


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``nodes`` (node, parent, depth, values) with the values summed over each node's subtree."""
    deepest = nodes.agg(F.max("depth")).first()[0]
    now = nodes.select("node", F.col("parent").alias("up"), "depth", *values)
    step = 1
    while deepest is not None and step <= deepest:
        # ``up`` is the ancestor ``step`` levels up; sums hold ``step`` levels, the node's own included.
        given = now.where(F.col("depth") >= step).groupBy(F.col("up").alias("node")).agg(*[F.sum(v).alias(f"more_{v}") for v in values])
        far = now.where(F.col("depth") >= step).select(F.col("node").alias("up"), F.col("up").alias("further"))
        summed = now.join(given, "node", "left").select("node", "up", "depth", *[
            (F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values])
        reach = F.when(F.col("depth") >= 2 * step, F.col("up"))
        now = scratch_table(summed.withColumn("up", reach).join(far, "up", "left").select(
            "node", F.col("further").alias("up"), "depth", *values), "subtrees")
        step *= 2
    return now.select("node", *values)


def trie(light: DataFrame, conversations: int = SHARD_CONVERSATIONS, turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of (conv_id, position, said, bytes): what ``op13_trie`` returns, and the node's digest.

    A row without ``said`` only says that its conversation exists.
    """
    local = scratch_table(local_nodes(light, conversations, turns), "shard_nodes")
    # Equal nodes of shards have equal parents, depths and last turns.
    nodes = scratch_table(local.groupBy("node").agg(
        F.any_value("parent").alias("parent"), F.any_value("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.any_value("bytes").alias("bytes")), "nodes")
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("lone"))
    grown = scratch_table(nodes.join(children, "node", "left").na.fill(0, ["n_children", "lone"]), "grown")
    shared = grown.where("n_convs > 1").select(
        "node", "parent", "depth", (F.col("lone") + (F.col("n_children") == 0).cast("bigint")).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    sums = subtree_sums(scratch_table(shared, "shared"), ["n_leaves", "saved_tokens"])
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = grown.join(sums, "node", "left").join(end_digests(local), "node", "left").join(above, "parent", "left")
    return whole.select("node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                        F.coalesce("n_leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
                        F.coalesce("saved_tokens", F.lit(0)).cast("bigint").alias("saved_tokens"),
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
