"""Targets, totals, draws and shards of the mix."""

import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyboard.llm import mixing as M, queries

SF = "/root/testdata/sf0.01"


def plain_targets(sizes):
    """Weights 1, 2, 3 repeating, raised together until all words are given out."""
    weights = [1 + i % 3 for i in range(len(sizes))]
    low, high = 0.0, 3.0 * sum(sizes) + 1
    for _ in range(200):
        unit = (low + high) / 2
        low, high = (unit, high) if sum(min(unit * w, 3 * s) for w, s in zip(weights, sizes)) < sum(sizes) else (low, unit)
    return [min(high * w, 3 * s) for w, s in zip(weights, sizes)]


@pytest.mark.parametrize("sizes", [[10], [1000, 1, 1, 1], [5, 0, 7], [100, 200, 300], [10**12, 3, 10**6, 5, 5, 5], [0, 0]])
def test_targets(sizes):
    got = M.targets(sizes, [1 + i % 3 for i in range(len(sizes))])
    np.testing.assert_allclose(got, plain_targets(sizes), rtol=1e-9, atol=1e-6)


def test_split_is_exact():
    rng = np.random.default_rng(0)
    for quotas, shards in [([5, 0, 17, 1], 4), ([1000, 3], 7), ([1], 5), ([0, 0], 3)]:
        dealt = M.split(np.array(quotas), shards, rng)
        assert dealt.shape == (shards, len(quotas)) and dealt.sum(axis=0).tolist() == quotas and dealt.min() >= 0
        totals = dealt.sum(axis=1)
        assert totals.max() - totals.min() <= 1


def sizes_of(rows):
    out = defaultdict(int)
    for _, text, source in rows:
        out[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return out


def test_query(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op6_mixing(spark, SF).collect()}
    sizes = sizes_of(rows)
    names = sorted(sizes, key=lambda s: (s is None, s))
    goal = dict(zip(names, plain_targets([sizes[s] for s in names])))
    taken, largest = Counter(), Counter()
    assert len(got) == len(rows)
    for i, text, source in rows:
        r = got[i]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) and r.source_size == sizes[source]
        assert r.target == pytest.approx(goal[source]) and 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    for s in names:
        # Left out or added, the last row in question is one that does not fit, and the nearer of both is chosen.
        assert abs(taken[s] - goal[s]) <= largest[s] / 2, (s, taken[s], goal[s])
    assert sum(abs(taken[s] - goal[s]) for s in names) < 0.005 * sum(goal.values())
    assert got == {r.doc_id: r for r in queries.op6_mixing(spark, SF).collect()}


def test_query_counts_what_the_mix_wrote(spark, monkeypatch):
    whole = {r.doc_id: r for r in queries.op6_mixing(spark, SF).collect()}
    mix = M.mix
    monkeypatch.setattr(M, "mix", lambda *a, **more: mix(*a, **more).where("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in queries.op6_mixing(spark, SF).collect()}
    assert got == {i: r if i % 2 == 0 else type(r)(**{**r.asDict(), "taken": 0}) for i, r in whole.items()}
    assert any(r.taken for i, r in whole.items() if i % 2)


def test_copies_of_every_row_are_counted(spark, make):
    docs = make([(None, "a b", None)] * 3 + [(1, "a b", "s"), (1, "a b", None), (1, None, "s"), (1, "", "s")]
                + [(i, f"w{i} x", "t") for i in range(2, 90)], "doc_id bigint, text string, source string")
    plan, rows = mixed(spark, docs, 3)
    mixture = spark.createDataFrame(rows, "doc_id bigint, text string, source string, shard int")
    counted = M.counted(docs.selectExpr("*", "text AS said"), plan, mixture, "m")
    got = [tuple(r) for r in counted.select("doc_id", "said", "source", "m.copies").collect()]
    assert len(got) == docs.count()
    total = Counter()
    for *row, copies in got:
        total[tuple(row)] += copies
    assert +total == Counter(r[:3] for r in rows)


def mixed(spark, docs, shards, **more):
    plan = M.make_plan(M.weigh(docs), shards, **more)
    return plan, [tuple(r) for r in M.mix(docs, plan, "shard").collect()]


def test_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan, rows = mixed(spark, docs, 8, blocks_per_shard=16)
    marked = {r[0]: r[1] for r in M.place(docs.select("doc_id", "text", "source"), plan, "m").select("doc_id", "m.shards").collect()}
    assert Counter(r[0] for r in rows) == Counter({i: len(s) for i, s in marked.items() if s})
    words = Counter()
    for r in rows:
        words[r[-1]] += len(r[1].split())
    assert set(words) == set(range(8)) and max(words.values()) < 2.5 * min(words.values())
    placed = M.mix(docs, plan, "shard").select("shard", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(placed) == 8 and len({r.p for r in placed}) == 8
    assert M.mix(docs, plan).columns == docs.columns


def test_shards_grow_with_the_words(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    light = M.weigh(docs)
    assert M.make_plan(light).shards == 64
    monkeypatch.setattr(M, "SHARD_WORDS", 1_000)
    monkeypatch.setattr(M, "MOST_BLOCKS", 1_000)
    plan = M.make_plan(light)
    assert plan.shards == -(-int(plan.sources["words"].sum()) // 1_000) > 100
    assert len(plan.draws) < 3 * plan.shards + 3 * len(plan.sources)


def test_finer_cuts(spark, monkeypatch):
    """A source of many more rows than a pool has is cut by several rounds of counts."""
    monkeypatch.setattr(M, "POOL_ROWS", 20)
    docs = spark.range(30_000).selectExpr("id AS doc_id", "repeat('w ', 1 + id % 90) AS text", "if(id % 10 = 0, 'b', 'a') AS source")
    plan, rows = mixed(spark, docs, 4)
    sizes = {s: w for s, w in zip(plan.sources["source"], plan.sources["words"])}
    goal = dict(zip(["a", "b"], plain_targets([sizes["a"], sizes["b"]])))
    taken = Counter()
    for _, text, source, _ in rows:
        taken[source] += len(text.split())
    assert all(abs(taken[s] - goal[s]) <= 90 for s in goal)
    assert max(Counter(r[0] for r in rows).values()) <= 3


@pytest.mark.parametrize("n, share", [(30_000, 2), (30_000, 3), (6_000, 2)])
def test_targets_hold_when_rows_repeat(spark, monkeypatch, n, share):
    """A group of equal rows that holds half or a third of a source, larger and smaller than a pool, under several ids."""
    monkeypatch.setattr(M, "PIECE", 1_000)
    for i in (0, 5):
        docs = spark.range(n).selectExpr(f"if(id % {share} = 0, -{i} - 1, id) AS doc_id", f"if(id % {share} = 0, 'one same row', repeat('w ', 1 + int(id % 5))) AS text",
                                         "if(id % 7 = 3, 'b', if(id % 7 = 5, 'c', 'a')) AS source")
        plan, rows = mixed(spark, docs, 16)
        sizes = dict(zip(plan.sources["source"], plan.sources["words"]))
        goal = dict(zip(sizes, plain_targets(list(sizes.values()))))
        taken = Counter()
        for _, text, source, _ in rows:
            taken[source] += len(text.split())
        assert all(abs(taken[s] - goal[s]) < 5 for s in goal), (taken, goal)
        have, copies = Counter(map(tuple, docs.collect())), Counter(r[:3] for r in rows)
        assert all(k <= 3 * have[r] for r, k in copies.items())
        # Copies of the repeated row are in every shard, about evenly.
        shards = Counter(r[3] for r in rows if r[0] == -i - 1)
        assert len(shards) == 16 and max(shards.values()) < 2 * min(shards.values())
        got = M.counted(docs, plan, spark.createDataFrame(rows, "doc_id bigint, text string, source string, shard int"), "m").select("doc_id", "source", "m.copies").collect()
        assert len(got) == n and max(r.copies for r in got) <= 3
        total = Counter()
        for r in got:
            total[r.doc_id, r.source] += r.copies
        assert +total == Counter((r[0], r[2]) for r in rows)
        assert sorted(rows) == sorted(mixed(spark, docs.repartition(3), 16)[1])


def test_repeated_rows_keep_their_other_columns(spark, make):
    docs = make([(1, "a b", "s", f"x{i}") for i in range(40)] + [(i, "c", "t", "y") for i in range(2, 90)], "doc_id bigint, text string, source string, other string")
    _, rows = mixed(spark, docs, 4)
    again = mixed(spark, docs.repartition(7), 4)[1]
    assert Counter(rows) == Counter(again)
    assert {r[3] for r in rows if r[0] == 1} <= {f"x{i}" for i in range(40)} and max(Counter(r[:4] for r in rows if r[0] == 1).values()) <= 3


def test_many_sources_are_planned_fast(spark):
    docs = spark.range(40_000).selectExpr("id AS doc_id", "repeat('w ', 1 + int(id % 9)) AS text", "concat('s', id % 20000) AS source")
    weighed = M.weigh(docs)
    start = time.time()
    plan = M.make_plan(weighed)
    assert time.time() - start < 15 and len(plan.sources) == 20_000


def test_edge_rows(spark, make):
    schema = "doc_id bigint, text string, source string, shard string, number int"
    same = [(7, "same row again", "s", "x", 1)] * 50
    docs = make([(1, None, None, "x", 1), (2, "", "s", None, 2), (None, "a b", None, "x", None), (3, "c d e", "é", "", 0),
                 (4, "word " * 30_000, "z", "x", 0), *same], schema)
    plan, rows = mixed(spark, docs, 3)
    counts = Counter(r[0] for r in rows)
    assert counts[7] <= 150 and all(n <= 3 for i, n in counts.items() if i != 7)
    assert plan.sources["source"].tolist() == ["s", "z", "é", None]
    plan, rows = mixed(spark, docs.limit(0), 3)
    assert rows == []
    plan, rows = mixed(spark, docs.where("text IS NULL OR text = ''"), 3)
    assert rows == []
