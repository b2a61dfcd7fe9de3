"""Approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product. One component is added to every vector so that all have the
length of the longest and the largest inner product is the smallest distance. A table
hashes a vector by ``functions`` random projections, each cut into cells of width
``width``; its cells together are its bucket. A query visits buckets of every table in the
order of their estimated success: the probability that a neighbour lies there, given where
the query lies. All candidates of a visited bucket are compared exactly, and the tables'
candidates are merged. A query's own class is always among them.

Equal vectors are searched once, as a class; of a class's ids the k + 1 smallest can be
needed and are kept. Buckets lie in groups of bounded size, a bucket too large for a group in several;
queries are streamed past them. No bucket is capped and no candidate of a visited bucket is
left out.

How alike neighbours are and how many buckets must be visited for the wanted recall is
measured on a sample of at most ``sample_rows`` vectors, in the driver. Neighbours in a
sample are farther than those in all rows, so this errs on the side of recall. The sample
also says how many pairs are compared with one table and with several, a pair that meets in
two tables counted twice. Clustered vectors get several;
where nearness is hardly better than chance one table that visits most buckets is best, as
it compares no pair twice.

Defined results: rows without an id, null and zero vectors, vectors with a null or
non-finite component or of another length than most take no part; rows that repeat id and
vector count once; fewer candidates than k give fewer rows; other columns play no part,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tallyboard.llm.vectors import is_query, laid_out, meetings, stacked, usable
from tallyboard.operators.joins import BROADCAST_ROWS
from tallyboard.session import scratch_table

TABLES = 4  # at most
WIDTH = 2.0  # of a cell, in standard deviations of a projection
BUCKET_ROWS = 1_024  # a table has about one bucket for so many rows, were all cells halves
GROUP_ROWS = 16_384
HELD_ROWS = 1_000_000  # found rows that a task holds before it sends some on
SAMPLE_ROWS = 4_096
SAMPLE_QUERIES = 128
RECALL = 0.96
CELLS = 16  # cells of one projection, the outer two unbounded
REACH = 2  # cells to either side of a query's own that are considered


@dataclass
class Index:
    """Random projections and what the sample has shown."""

    directions: np.ndarray  # tables, dimensions + 1, functions
    shifts: np.ndarray  # tables, functions
    width: float
    longest: float
    alike: float  # how much of a projection a neighbour shares
    probes: int = 1

    def lifted(self, x: np.ndarray, as_query: bool) -> np.ndarray:
        """Vectors of length 1 whose distances order as the inner products do."""
        length = np.sqrt((x * x).sum(axis=1))
        if as_query:
            return np.column_stack([x / length[:, None], np.zeros(len(x))])
        return np.column_stack([x / self.longest, np.sqrt(np.maximum(0, 1 - (length / self.longest) ** 2))])

    def _cells(self, t: int, projected: np.ndarray) -> np.ndarray:
        cells = np.floor((projected + self.shifts[t]) / self.width).astype(np.int64) + CELLS // 2
        return np.clip(cells, 0, CELLS - 1)

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """(tables, vectors) bucket numbers of candidates: the cells as digits."""
        lifted = self.lifted(x, as_query=False)
        return np.stack([_code(self._cells(t, lifted @ d)) for t, d in enumerate(self.directions)])

    def visits(self, x: np.ndarray, t: int, probes: int) -> np.ndarray:
        """(queries, probes) buckets of a table, the likeliest first.

        The logarithm of a bucket's success is a sum over the projections, so the best
        sums of all projections extend the best sums of fewer.
        """
        projected = self.lifted(x, as_query=True) @ self.directions[t]
        own = self._cells(t, projected)
        options = np.clip(own[:, :, None] + np.arange(-REACH, REACH + 1), 0, CELLS - 1)
        spread = math.sqrt(max(1e-6, 1 - self.alike ** 2))
        low = (options - CELLS // 2) * self.width - self.shifts[t][None, :, None] - self.alike * projected[:, :, None]
        chance = _normal((low + self.width) / spread) - _normal(low / spread)
        gain = np.log(np.maximum(chance, 1e-300))
        gain[:, :, 1:][options[:, :, 1:] == options[:, :, :-1]] = -np.inf  # the outer cell once
        total, code = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
        for f in range(projected.shape[1]):
            total = (total[:, :, None] + gain[:, None, f, :]).reshape(len(x), -1)
            code = (code[:, :, None] * CELLS + options[:, None, f, :]).reshape(len(x), -1)
            best = np.argsort(-total, axis=1, kind="stable")[:, :probes]
            total, code = np.take_along_axis(total, best, 1), np.take_along_axis(code, best, 1)
        return np.where(np.isfinite(total), code, -1)


def _code(cells: np.ndarray) -> np.ndarray:
    code = np.zeros(len(cells), np.int64)
    for f in range(cells.shape[1]):
        code = code * CELLS + cells[:, f]
    return code


def _normal(z: np.ndarray) -> np.ndarray:
    """Standard normal distribution function, to about seven digits."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    tail = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z > 0, 1 - tail, tail)


def _visits_needed(index: Index, x: np.ndarray, asking: np.ndarray, near: np.ndarray, recall: float) -> tuple[int, float]:
    """Buckets of every table to visit for this share of the neighbours, and the pairs that are then compared, per vector and query."""
    codes, most = index.buckets(x), 64
    functions, tables = index.directions.shape[2], len(index.directions)
    while True:
        first = np.full(near.shape, most)
        for t in range(tables):
            seen = index.visits(x[asking], t, most)
            hits = seen[:, None, :] == codes[t][near][:, :, None]
            first = np.minimum(first, np.where(hits.any(axis=2), hits.argmax(axis=2), most))
        found = np.sort(first.ravel())
        need = int(found[min(len(found) - 1, math.ceil(recall * len(found)) - 1)])
        if need < most or most > (2 * REACH + 1) ** functions:
            break
        most *= 4
    probes = min(need, most - 1) + 1
    pairs = 0
    for t in range(tables):
        names, sizes = np.unique(codes[t], return_counts=True)
        visits = index.visits(x[asking], t, probes)
        at = np.minimum(np.searchsorted(names, visits), len(names) - 1)
        pairs += sizes[at][names[at] == visits].sum()
    return probes, pairs / (len(asking) * len(x))


def fit(classes: DataFrame, total: int, k: int, tables: int | None = None, functions: int | None = None, width: float = WIDTH,
        recall: float = RECALL, sample_rows: int = SAMPLE_ROWS, probes: int | None = None, seed: int = 1) -> Index | None:
    """Index for ``total`` distinct vectors, fitted on a sample of at most ``sample_rows`` of them."""
    if not total:
        return None
    share = min(1.0, sample_rows / total)
    drawn = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1_000_000)) < math.ceil(share * 1_000_000)
    rows = classes.where(drawn).select("id", "vec").limit(2 * sample_rows).collect()
    longest = classes.agg(F.sqrt(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)))).first()[0]
    dimensions = len(classes.select("vec").first()[0])
    if functions is None:
        functions = max(2, min(15, round(math.log2(max(2, total / BUCKET_ROWS)))))
    rng = np.random.default_rng(seed)
    most = tables or TABLES
    index = Index(rng.normal(size=(most, dimensions + 1, functions)), rng.uniform(0, width, (most, functions)), width, longest, 0.5)
    x = np.array([r["vec"] for r in sorted(rows, key=lambda r: r["id"])], np.float64).reshape(-1, dimensions)[:sample_rows]
    if len(x) > 1:
        asking = rng.permutation(len(x))[:SAMPLE_QUERIES]
        scores = x[asking] @ x.T
        scores[np.arange(len(asking)), asking] = -np.inf
        near = np.argsort(-scores, axis=1)[:, :min(k, len(x) - 1)]
        lifted, asked = index.lifted(x, False), index.lifted(x[asking], True)
        # The least alike of the wanted neighbours decide how far to look.
        index.alike = float(np.clip(np.median((asked * lifted[near[:, -1]]).sum(axis=1)), 0.05, 0.999))
    index.probes = probes or 1
    if probes is None and len(x) > 1:
        sizes = [tables] if tables else [TABLES, 1]
        tried = [replace(index, directions=index.directions[:n], shifts=index.shifts[:n]) for n in sizes]
        needs = [_visits_needed(i, x, asking, near, recall) for i in tried]
        # One table alone loses whole clusters at the edges of its cells, so it is for spread vectors only.
        fit_for = [i for i in range(len(tried)) if sizes[i] > 1 or tables or needs[i][1] > 1 / 2]
        best = min(fit_for, key=lambda i: needs[i][1])
        index = replace(tried[best], probes=needs[best][0])
    return index


def classes_of(rows: DataFrame, k: int, every: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct vectors (id, least, vec), their members (id, member), and the queries (id, query_id).

    A class has a number of its own, ``least`` is its smallest id. Members are the k + 1
    smallest ids: no other id can be among the k nearest of any query.
    """
    distinct = rows.groupBy("vec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    distinct = scratch_table(distinct.withColumn("id", F.monotonically_increasing_id()), "classes")
    copied = distinct.where("n > 1").select(F.col("id").alias("class"), F.col("vec").alias("v"))
    copies = scratch_table(rows.join(copied, F.col("vec") == F.col("v")).select("class", "id").distinct(), "copies")
    single = distinct.where("n = 1").select(F.col("id").alias("class"), F.col("least").alias("id"))
    order = Window.partitionBy("class").orderBy("id")
    first = copies.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1).select("class", "id")
    members = single.unionByName(first).select(F.col("class").alias("id"), F.col("id").alias("member"))
    queries = single.unionByName(copies).where(is_query(F.col("id"), every)).select(
        F.col("class").alias("id"), F.col("id").alias("query_id"))
    return distinct.select("id", "least", "vec"), scratch_table(members, "members"), scratch_table(queries, "queries")


class Group:
    """Candidates of one group, by bucket."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values(["bucket", "least", "id"])
        self.ids, self.least, self.x = rows["id"].to_numpy(), rows["least"].to_numpy(), stacked(rows)
        bucket = rows["bucket"].to_numpy()
        names, starts = np.unique(bucket, return_index=True)
        ends = [*starts[1:].tolist(), len(bucket)]
        self.span = dict(zip(names.tolist(), zip(starts.tolist(), ends)))

    def nearest(self, q: np.ndarray, visits: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(queries, k) scores and positions of the best in the buckets each query visits; -inf where there are fewer."""
        score, place = np.full((len(q), k), -np.inf), np.zeros((len(q), k), np.int64)
        asking: dict[int, list[int]] = {}
        for i, mine in enumerate(visits):
            for b in mine.tolist():
                if b in self.span:
                    asking.setdefault(b, []).append(i)
        for b, who in asking.items():
            a, z = self.span[b]
            new = q[who] @ self.x[a:z].T
            at = np.argsort(-new, axis=1, kind="stable")[:, :k]
            both = np.concatenate([score[who], np.take_along_axis(new, at, 1)], axis=1)
            where = np.concatenate([place[who], at + a], axis=1)
            best = np.lexsort((self.ids[where], self.least[where], -both))[:, :k]
            score[who], place[who] = np.take_along_axis(both, best, 1), np.take_along_axis(where, best, 1)
        return score, place


def best_of(query: np.ndarray, ids: np.ndarray, least: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best candidates of every query, each once."""
    order = np.lexsort((ids, least, -score, query))
    query, ids, least, score = query[order], ids[order], least[order], score[order]
    # A pair that several tables found has one score, so its rows are neighbours.
    once = np.append(True, (query[1:] != query[:-1]) | (ids[1:] != ids[:-1]))[:len(query)]
    query, ids, least, score = query[once], ids[once], least[once], score[once]
    first = np.append(True, query[1:] != query[:-1])[:len(query)]
    rank = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
    return query[rank < k], ids[rank < k], least[rank < k], score[rank < k]


def _frames(found: tuple[np.ndarray, ...]) -> Iterator[pd.DataFrame]:
    for a in range(0, len(found[0]), 100_000):
        yield pd.DataFrame({n: c[a:a + 100_000] for n, c in zip(("query", "id", "least", "score"), found)})


def search(classes: DataFrame, asking: DataFrame, index: Index, total: int, k: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(query, id, least, score): for every class in ``asking``, the k best classes found by each task, exact scores."""
    tables = len(index.directions)
    groups = -(-total // group_rows)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                codes = index.buckets(stacked(rows))
                for t in range(tables):
                    yield rows.assign(t=t, bucket=codes[t])

    schema = "id bigint, least bigint, vec array<double>, t int, bucket bigint"
    candidates = scratch_table(classes.select("id", "least", "vec").mapInPandas(hashed, schema), "hashed")
    # Buckets too large for a group are dealt to several; there are few of them by their size,
    # and the size is raised if they might be more than the library broadcasts.
    large = max(group_rows, -(-tables * total // BROADCAST_ROWS))
    crowded = candidates.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > large)
    parts = {(r["t"], r["bucket"]): -(-r["n"] // large) for r in crowded.collect()}

    def group_of(t, bucket: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Group number of a part of a bucket: a mixed hash, modulo the groups of its table."""
        mixed = bucket.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return t * groups + ((mixed >> np.uint64(33)) % np.uint64(groups)).astype(np.int64)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            t, bucket = rows.pop("t").to_numpy().astype(np.int64), rows["bucket"].to_numpy()
            part = np.zeros(len(rows), np.uint64)
            if parts:
                among = np.array([parts.get(tb, 1) for tb in zip(t.tolist(), bucket.tolist())], np.uint64)
                part = (rows["id"].to_numpy().astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)) % among
            yield rows.assign(key=group_of(t, bucket, part), asks=0, visits=None)[names]

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for a in range(0, len(rows), 512):
                some = rows.iloc[a:a + 512]
                x, ids, out = stacked(some), some["id"].to_numpy(), []
                for t in range(tables):
                    for i, buckets in enumerate(index.visits(x, t, index.probes)):
                        buckets = buckets[buckets >= 0]
                        count = np.array([parts.get((t, b), 1) for b in buckets.tolist()], np.int64)
                        each = np.repeat(buckets, count)
                        key = group_of(t, each, np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count))
                        order = np.argsort(key, kind="stable")
                        keys, starts = np.unique(key[order], return_index=True)
                        for g, mine in zip(keys.tolist(), np.split(each[order], starts[1:])):
                            out.append((g, 1, ids[i], 0, -1, np.unique(mine), some["vec"].iloc[i]))
                yield pd.DataFrame(out, columns=names)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held, size = None, [], 0
        for rows, some in meetings(batches):
            if rows is not None:
                group = Group(rows)
            for a in range(0, len(some), 1024):
                part = some.iloc[a:a + 1024]
                q = stacked(part)
                score, place = group.nearest(q, [np.asarray(v, np.int64) for v in part["visits"]], k)
                who, slot = np.nonzero(np.isfinite(score))
                at = place[who, slot]
                # The exact measure, summed component by component, alike wherever two vectors meet.
                exact = np.zeros(len(at))
                for d in range(q.shape[1]):
                    exact += q[who, d] * group.x[at, d]
                held.append((part["id"].to_numpy()[who], group.ids[at], group.least[at], exact))
                size += len(at)
            if size > HELD_ROWS:
                # A task's groups share their queries: only the best of all of them go on.
                held = [best_of(*map(np.concatenate, zip(*held)), k)]
                size = len(held[0][0])
                if size > HELD_ROWS // 2:
                    yield from _frames(held[0])
                    held, size = [], 0
        if held:
            yield from _frames(best_of(*map(np.concatenate, zip(*held)), k))

    names = ["key", "asks", "id", "least", "bucket", "visits", "vec"]
    schema = "key bigint, asks int, id bigint, least bigint, bucket bigint, visits array<bigint>, vec array<double>"
    laid = candidates.mapInPandas(placed, schema).unionByName(asking.mapInPandas(asked, schema))
    # Every task a query comes to sends on k rows for it, so there are only as many tasks as keep the cores busy.
    return laid_out(laid, tables * groups, per_core=2).mapInPandas(compare, "query bigint, id bigint, least bigint, score double")


def nearest(vectors: DataFrame, k: int, every: int, id_col: str = "vec_id", vector: str = "embedding",
            index: Index | None = None, group_rows: int = GROUP_ROWS, **options) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of all other rows, for ids divisible by ``every``."""
    rows = usable(vectors, id_col, vector, zero_too=False)
    classes, members, queries = classes_of(rows, k, every)
    total = classes.count()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    index = index or fit(classes, total, k, **options)
    if index is None:
        return vectors.sparkSession.createDataFrame([], schema)
    asking = classes.join(queries.select("id").distinct(), "id", "left_semi")
    found = scratch_table(search(classes, asking, index, total, k + 1, group_rows), "found")
    # A query's own class needs no bucket, so that exact copies are never lost; its score is summed as in all comparisons.
    itself = asking.select(F.col("id").alias("query"), "id", "least", F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x).alias("score"))
    found = found.unionByName(itself)
    # The same pair comes from several tables, with the same score.
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "least", "id")
    found = found.distinct().withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "member")
    whole = (found.join(members, "id").withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
             .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("at", "member", "score"))).alias("best")))
    ranked = queries.join(whole, F.col("id") == F.col("query")).select("query_id", F.slice(F.filter(
        "best", lambda b: b["member"] != F.col("query_id")), 1, k).alias("best"))
    return ranked.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.member").alias("vec_id"), "b.score")
