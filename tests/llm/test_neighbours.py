"""Recall against brute force, exact scores, ties and edge rows."""

import numpy as np
import pytest

from tallyboard.llm import neighbours as N, queries


def brute(rows, k, every):
    """{query: [(id, score)]} by plain sums over distinct (id, vector)."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for i, q in rows:
        if i % every == 0:
            scores = []
            for j, v in rows:
                if j != i:
                    s = 0.0
                    for a, b in zip(q, v):
                        s += a * b
                    scores.append((-s, j))
            out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({j for j, _ in got.get(i, [])} & {j for j, _ in w}) / len(w) for i, w in want.items()])


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_recall(spark, sf):
    vectors = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = by_query(queries.op3_neighbours(spark, f"/root/testdata/{sf}"))
    x = {i: np.array(v) for i, v in rows}
    ids = np.array(sorted(x))
    m = np.array([x[i] for i in ids])
    hit = total = 0
    assert sorted(got) == [i for i in ids if i % 20 == 0]
    for i, found in got.items():
        assert len(found) == 20 and found == sorted(found, key=lambda f: (-f[1], f[0])) and i not in {j for j, _ in found}
        for j, score in found:
            assert score == pytest.approx(float(x[i] @ x[j]), rel=1e-12)
        scores = m @ x[i]
        best = [j for j in ids[np.lexsort((ids, -scores))] if j != i][:20]
        hit += len({j for j, _ in found} & set(best))
        total += 20
    print("recall", sf, hit / total)
    assert hit / total >= 0.9


def test_all_buckets_give_the_exact_answer(spark):
    """Visiting every bucket, with crowded buckets in several groups, ties and copies: nothing is lost."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 4)) * 1.4) / 2
    x[:150] = x[0]
    x[~x.any(axis=1)] = 1.0
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(400), x)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = by_query(N.nearest(vectors, 6, 5, group_rows=20, functions=2, probes=25))
    assert got == brute(rows, 6, 5)


def test_clustered_vectors_need_few_visits(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(40, 16))
    x = centers[rng.integers(40, size=4000)] + 0.05 * rng.normal(size=(4000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = by_query(N.nearest(vectors, 10, 100, functions=6))
    assert recall(got, brute(rows, 10, 100)) >= 0.9
    classes, _, _ = N.classes_of(N.usable(vectors, "vec_id", "embedding", False), 10, 100)
    assert N.fit(classes, 4000, 10, functions=6).probes <= 16


def test_visits_are_ordered_by_success():
    rng = np.random.default_rng(1)
    index = N.Index(rng.normal(size=(1, 6, 3)), rng.uniform(0, 2, (1, 3)), 2.0, 1.0, 0.6)
    q = rng.normal(size=(1, 5))
    visits = index.visits(q, 0, 125)[0]
    visits = visits[visits >= 0]
    assert len(set(visits.tolist())) == len(visits)
    # Points that share 0.6 of the query's projections fall into early buckets most often.
    near = 0.6 * (index.lifted(q, True) @ index.directions[0]) + 0.8 * rng.normal(size=(20000, 3))
    codes, counts = np.unique(N._code(index._cells(0, near)), return_counts=True)
    count = dict(zip(codes.tolist(), counts.tolist()))
    seen = np.array([count.get(v, 0) for v in visits.tolist()])
    assert seen.sum() > 19500 and all(seen[a:a + 10].mean() >= seen[a + 10:a + 20].mean() for a in range(0, 40, 10))


def test_edge_rows(spark, make):
    schema = "vec_id bigint, embedding array<float>, vec string, least int"
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [2.0, 0.0]), (20, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (40, [nan, 1.0]),
            (60, [inf, 1.0]), (80, [1.0]), (None, [1.0, 1.0]), (100, [None, 1.0]), (-20, [-1.0, 0.0])]
    got = by_query(N.nearest(make([(*r, "x", 1) for r in rows], schema), 20, 20))
    fine = [(i, v) for i, v in rows if i in (0, 1, 2, 20, -20)]
    assert got == brute(fine, 20, 20)
    assert N.nearest(make([], schema), 20, 20).count() == 0
    assert N.nearest(make([(0, [1.0, 0.0], "x", 1)], schema), 20, 20).count() == 0


def test_copies_are_found_though_their_bucket_is_not_visited(spark):
    rng = np.random.default_rng(1)
    shape = N.TABLES, 9, 2
    index = N.Index(rng.normal(size=shape), rng.uniform(0, N.WIDTH, (N.TABLES, 2)), N.WIDTH, 1.0, 0.5)
    for x in np.random.default_rng(2).normal(size=(2_000, 8)):
        index.longest = float(np.sqrt(x @ x))
        own = index.buckets(x[None])
        if all(index.visits(x[None], t, 1)[0, 0] != own[t, 0] for t in range(N.TABLES)):
            break
    else:
        raise AssertionError("no such vector")
    rows = [(i, x.tolist()) for i in range(30)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert by_query(N.nearest(vectors, 6, 5)) == brute(rows, 6, 5)
    assert by_query(N.nearest(vectors, 6, 5, index=index)) == brute(rows, 6, 5)
