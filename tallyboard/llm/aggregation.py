"""Exact top-k inner products by aggregation without random access.

Vectors become integers, floor(scale * x). Candidates lie in blocks; a block keeps one list
per dimension, sorted by component. For a query, the list of dimension d, read from the
end where its products are largest, is a sorted list of partial scores. All lists are read
on together, to the same depth, for many queries at once: queries share the lists, and only
the sign of their weight tells from which end. What has been read of a candidate, plus the
last value read of every list in which it has not come up yet, bounds its score from above;
plus the list's very last value, from below. Nothing else is known of a candidate while the
lists are read. A read list so gives every candidate one number, its component or the bound
on it, and the bounds of all pairs of queries and candidates are one product of weights and
these numbers. A query reads on until few candidates can still reach the k-th best lower
bound, or the k-th best score of the blocks before; then the scores of those few are
resolved. It does not read a block at all whose first values do not reach that score. The
first blocks of a task are small, and long vectors come first, so that such a score is known
soon. The best of all blocks are the answer.

Every query meets every block: the search is exact, so its work is queries times
candidates. Neither side is ever in one task: a task holds a bounded number of blocks of
bounded size, and queries are streamed past them; so a query moves once for CELL_ROWS
candidates.

Scores are sums of whole numbers and exact while they stay below 2**53.

Defined results: rows without an id and vectors that are null, or hold a null or
non-finite component, or have another length than most, take no part; rows that repeat an id are
all candidates, but never of a query of that id; fewer candidates than k give fewer rows;
other columns play no part, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tallyboard.llm.vectors import is_query, laid_out, meetings, stacked, usable
from tallyboard.session import scratch_table

BLOCK_ROWS = 4_096
BLOCK_NUMBERS = 1 << 20  # components of a block, at most, if it has several rows
CELL_ROWS = 1 << 16  # candidates that a task holds, in blocks
CELL_NUMBERS = 1 << 23  # their components, at most
# Parts of the lists that are read before bounds are compared.
DEPTHS = (1 / 2, 3 / 4, 7 / 8, 15 / 16, 31 / 32, 1)
RESOLVED = 16  # reading stops when one candidate in so many can still qualify
ASKED = 512  # queries that read the lists together
RESOLVED_NUMBERS = 1 << 21  # components that are resolved at once
HAIR = 2.0 ** -45  # part of the largest sums by which those beyond 2**53 can be off

Found = tuple[np.ndarray, np.ndarray, np.ndarray]  # which query, which id, which score


def k_best(found: Found, k: int) -> Found:
    """The k best of every query, in order, ties to smaller ids."""
    rows, ids, scores = found
    order = np.lexsort((ids, -scores, rows))
    rows = rows[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    best = order[place < k]
    return found[0][best], ids[best], scores[best]


class Block:
    """Candidates and their sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], vectors[order]
        # Every dimension's list: which candidate, which component. Negative weights read it from the start, others from the end.
        self.items = np.ascontiguousarray(np.argsort(self.x, axis=0, kind="stable").T)
        self.values = np.take_along_axis(self.x.T, self.items, axis=1)
        self.read = 0  # entries of lists, by all queries

    def tops(self, query_ids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray) -> Found:
        """The k best of every query but its own, ties to smaller ids; those below its ``floor`` may be left out."""
        rows, items = np.nonzero(self._open(q, self.ids != query_ids[:, None], k, floor))
        scores, step = np.empty(len(rows)), max(1, RESOLVED_NUMBERS // self.x.shape[1])
        for a in range(0, len(rows), step):
            scores[a:a + step] = np.einsum("ij,ij->i", self.x[items[a:a + step]], q[rows[a:a + step]])
        good = scores >= floor[rows]
        return k_best((rows[good], self.ids[items[good]], scores[good]), k)

    def top(self, query_id: int, q: np.ndarray, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of one query."""
        return self.tops(np.array([query_id]), q[None], k, np.array([floor]))[1:]

    def _contenders(self, q: np.ndarray, used: np.ndarray, allowed: np.ndarray, k: int, floor: float = -np.inf) -> np.ndarray:
        """Candidates of one query that can still be among the k best when reading stops; weights but ``used`` are zero."""
        open_ = np.zeros((1, len(self.ids)), bool)
        open_[0, allowed] = True
        return np.flatnonzero(self._open(q[None], open_, k, np.array([floor])))

    def _open(self, q: np.ndarray, allowed: np.ndarray, k: int, floor: np.ndarray) -> np.ndarray:
        """Which candidates can still be among the k best of which query when reading stops; the lists are all that is read."""
        n, width = len(self.ids), q.shape[1]
        # Lists read from the end, then those read from the start; a query's weight in one of the two is zero.
        weights = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1)
        heads, lasts = np.concatenate([self.values[:, -1], self.values[:, 0]]), np.concatenate([self.values[:, 0], self.values[:, -1]])
        hair = HAIR * (np.abs(weights) @ np.maximum(np.abs(heads), np.abs(lasts)))
        open_ = allowed & (weights @ heads >= floor - hair)[:, None]
        few = max(4 * k, n // RESOLVED)
        reading = np.flatnonzero(q.any(axis=1) & (np.count_nonzero(open_, axis=1) > RESOLVED))
        floor, done = floor.copy(), 0
        # What has not been read of a candidate is at least, in its product, the list's last value.
        least = np.repeat(lasts[:, None], n, axis=1) if len(reading) else None
        for depth in DEPTHS:
            if not len(reading):
                break
            upto = max(done + 1, int(n * depth))
            np.put_along_axis(least[:width], self.items[:, n - upto:n - done], self.values[:, n - upto:n - done], axis=1)
            np.put_along_axis(least[width:], self.items[:, done:upto], self.values[:, done:upto], axis=1)
            self.read += (upto - done) * np.count_nonzero(q[reading])
            done = upto
            # And at most the last value read.
            most = np.concatenate([np.maximum(least[:width], self.values[:, n - done, None]), np.minimum(least[width:], self.values[:, done - 1, None])])
            above = weights[reading] @ most
            now = open_[reading] & (above >= (floor - hair)[reading, None])
            many = np.count_nonzero(now, axis=1) > few
            open_[reading] = now
            # Lower bounds raise the floor of those whom upper bounds alone leave too many.
            reading, now, above = reading[many], now[many], above[many]
            if n >= k and len(reading):
                below = np.where(allowed[reading], weights[reading] @ least, -np.inf)
                floor[reading] = np.maximum(floor[reading], np.partition(below, n - k, axis=1)[:, n - k] - hair[reading])
                now &= above >= (floor - hair)[reading, None]
                open_[reading] = now
                reading = reading[np.count_nonzero(now, axis=1) > few]
            if done == n:
                break
        return open_


def blocks_of(ids: np.ndarray, x: np.ndarray, block_rows: int) -> list[Block]:
    """Blocks of at most ``block_rows`` candidates, long vectors first, each twice the one before up to that size."""
    order = np.argsort(-np.einsum("ij,ij->i", x, x), kind="stable")
    block_rows = max(1, min(block_rows, BLOCK_NUMBERS // max(1, x.shape[1])))
    cuts, rows = [0], max(1, block_rows // 8)
    while cuts[-1] < len(ids):
        cuts.append(min(len(ids), cuts[-1] + rows))
        rows = min(block_rows, 2 * rows)
    return [Block(ids[order[a:b]], x[order[a:b]]) for a, b in zip(cuts, cuts[1:])]


def best_of_all(blocks: list[Block], query_ids: np.ndarray, q: np.ndarray, k: int) -> Found:
    """The k best of several blocks for every query; what the first ones gave bounds the answer of the others."""
    parts = []
    for a in range(0, len(query_ids), ASKED):
        asked, weights = query_ids[a:a + ASKED], q[a:a + ASKED]
        found, floor = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), np.full(len(asked), -np.inf)
        for block in blocks:
            more = block.tops(asked, weights, k, floor)
            found = k_best(tuple(np.concatenate(both) for both in zip(found, more)), k)
            counts = np.bincount(found[0], minlength=len(asked))
            full = counts == k
            floor[full] = found[2][np.cumsum(counts)[full] - 1]
        parts.append((found[0] + a, *found[1:]))
    return tuple(np.concatenate(part) for part in zip(*parts))


def best_of(blocks: list[Block], query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of one query."""
    return best_of_all(blocks, np.array([query_id]), q[None], k)[1:]


def top_k(vectors: DataFrame, k: int, every: int, scale: int = 256, id_col: str = "vec_id", vector: str = "embedding",
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows, for ids divisible by ``every``."""
    rows = usable(vectors, id_col, vector, zero_too=True)
    rows = scratch_table(rows.select("id", F.transform("vec", lambda x: F.floor(x * scale).cast("double")).alias("vec")), "scaled")
    spark = vectors.sparkSession
    total, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    # Cells are bounded in size, also where rows repeat an id; small tables have as many as keep the cores busy.
    cell_rows = max(block_rows, min(CELL_ROWS, CELL_NUMBERS // max(1, width or 1)) // block_rows * block_rows)
    cells = max(-(-total // cell_rows), min(2 * spark.sparkContext.defaultParallelism, -(-total // 512)), 1)
    candidates = rows.select(F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(cells)).cast("int").alias("key"), F.lit(0).alias("asks"), "id", "vec")
    queries = rows.where(is_query(F.col("id"), every)).distinct().select(
        F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("key"), F.lit(1).alias("asks"), "id", "vec")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[Block] = []
        for group, asking in meetings(batches):
            if group is not None:
                held = blocks_of(group["id"].to_numpy(), stacked(group), block_rows)
            rows, ids, scores = best_of_all(held, asking["id"].to_numpy(), stacked(asking), k)
            yield pd.DataFrame({"query_id": asking["id"].to_numpy()[rows], "vec_id": ids, "score": scores.astype(np.int64)})

    found = laid_out(candidates.unionByName(queries), cells).mapInPandas(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
