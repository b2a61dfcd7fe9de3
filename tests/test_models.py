"""Tree ensembles and kernel machines against plain walks and sums, and against fitted Spark models."""

import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tallyboard.operators import kernels, ranking, scoring, trees
from tallyboard.session import scratch_path

FEATURES = ("A%", "b/c", "d")


@pytest.fixture(scope="module")
def table(spark):
    r = random.Random(1)
    rows = [(i, *[r.choice([None, float("nan"), r.uniform(-3, 3), float(r.randrange(-2, 3))]) for _ in FEATURES]) for i in range(300)]
    return spark.createDataFrame(rows, "id int, `A%` double, `b/c` double, d double")


def random_tree(r, tree, levels):
    """Nodes in the order of a depth-first walk, of uneven depth."""
    rows = []

    def grow(level):
        at = len(rows)
        rows.append(None)
        if level == levels or level and r.random() < 0.2:
            rows[at] = (tree, at, None, None, None, None, None, r.uniform(-1, 1))
        else:
            low, high = grow(level + 1), grow(level + 1)
            rows[at] = (tree, at, r.choice(FEATURES), float(r.randrange(-2, 3)), low, high, r.choice([None, low, high]), None)
        return at
    grow(0)
    return rows


def walk(nodes, tree, x):
    at = 0
    while True:
        _, _, feature, threshold, low, high, missing, value = nodes[tree, at]
        if feature is None:
            return value
        v = x[feature]
        if v is None or math.isnan(v):
            at = high if missing is None else missing
        else:
            at = low if v <= threshold else high


@pytest.mark.parametrize("combine, levels", [("mean", 5), ("sum", 3), ("median", 4), ("mean", 0)])
def test_ensembles_equal_plain_walks(spark, table, combine, levels):
    r = random.Random(levels)
    rows = [n for t in range(7) for n in random_tree(r, t, levels)]
    weights = () if combine == "mean" else tuple(r.choice([0.5, 1.0, 2.5]) for _ in range(7))
    model = trees.TreeModel(spark.createDataFrame(r.sample(rows, len(rows)), trees.NODES), FEATURES, combine, 0.25, weights)
    path = scratch_path(spark, "trees")
    trees.save_trees(model, path)
    nodes = {(n[0], n[1]): n for n in rows}
    for m in (model, trees.load_trees(spark, path)):
        for got in trees.tree_scorer(m)(table, "score").collect():
            leaves = [walk(nodes, t, got.asDict()) for t in range(7)]
            if combine == "median":
                seen, half = 0.0, sum(weights) / 2
                for leaf, w in sorted(zip(leaves, weights)):
                    seen += w
                    if seen >= half:
                        break
                assert got.score == leaf
            else:
                want = sum(leaves) / 7 if combine == "mean" else 0.25 + sum(w * v for w, v in zip(weights, leaves))
                assert got.score == pytest.approx(want, abs=1e-12)


def test_fitted_models_score_alike_from_their_nodes(spark, table, plan):
    whole = table.na.drop().withColumn("label", F.col("A%") * F.col("d") + F.col("b/c"))
    plain = whole.select("id", "label", *[F.col(f"`{f}`").alias(f"f{i}") for i, f in enumerate(FEATURES)])
    vectors = VectorAssembler(inputCols=["f0", "f1", "f2"], outputCol="features").transform(plain)
    forest = RandomForestRegressor(numTrees=5, maxDepth=4, seed=3).fit(vectors)
    boosted = GBTRegressor(maxIter=6, maxDepth=3, stepSize=0.3, seed=3).fit(vectors)
    for fitted, model in ((forest, trees.TreeModel(trees.nodes_of_trees(spark, forest.trees, FEATURES), FEATURES)),
                          (boosted, trees.TreeModel(trees.nodes_of_trees(spark, boosted.trees, FEATURES), FEATURES, "sum", 0.0, tuple(boosted.treeWeights)))):
        want = {r.id: r.prediction for r in fitted.transform(vectors).collect()}
        scored = trees.tree_scorer(model)(whole, "score")
        assert {r.id: r.score for r in scored.collect()} == pytest.approx(want, abs=1e-9)
        text = plan(scored)
        assert "EvalPython" not in text and "InPandas" not in text and "InArrow" not in text


def test_node_tables_that_are_no_trees(make, monkeypatch):
    leaf = (0, 0, None, None, None, None, None, 1.0)
    split = (0, 0, "d", 0.5, 1, 2, None, None)
    ends = [(0, 1, None, None, None, None, None, 1.0), (0, 2, None, None, None, None, None, 2.0)]

    def refused(rows, match, **more):
        with pytest.raises(trees.ModelError, match=match):
            trees.TreeModel(make(rows, trees.NODES), FEATURES, **more).checked()
    refused([], "no tree")
    refused([leaf], "combine", combine="vote")
    refused([(0, 0, "d", 0.5, 0, 1, None, None), ends[0]], "bad")  # a child that is its own parent
    refused([(0, 0, "gone", 0.5, 1, 2, None, None), *ends], "unknown")
    refused([(0, 0, None, None, None, None, None, None)], "empty")
    refused([split, *ends, ends[1]], "gaps")
    refused([split, ends[0]], "outside")
    refused([(1, *leaf[1:])], "numbered")
    refused([leaf], "weights", weights=(1.0, 2.0))
    monkeypatch.setattr(trees, "MODEL_BYTES", 100)
    refused([split, *ends], "bytes")


@pytest.mark.parametrize("kernel, block_bytes", [("rbf", 1 << 20), ("rbf", 300), ("linear", 1 << 20), ("poly", 700)])
def test_kernel_machines_equal_plain_sums(spark, table, kernel, block_bytes):
    r = random.Random(2)
    support = [([r.uniform(-2, 2) for _ in FEATURES], r.uniform(-1, 1)) for _ in range(40)]
    support += support[:3]  # repeated vectors count again
    df = spark.createDataFrame(support, "vector array<double>, coefficient double")
    model = kernels.KernelModel(df, FEATURES, kernel, gamma=0.7, degree=3, offset=0.5, intercept=-0.25)
    assert (kernels.measured_blocks(model, block_bytes) > 1) == (block_bytes < 1 << 20)

    def one(x, v):
        dot = sum(a * b for a, b in zip(x, v))
        return {"rbf": math.exp(-0.7 * sum((a - b) ** 2 for a, b in zip(x, v))), "linear": dot, "poly": (0.7 * dot + 0.5) ** 3}[kernel]
    for got in kernels.kernel_scorer(model, block_bytes)(table, "score").collect():
        x = [got[f] for f in FEATURES]
        if any(v is None or math.isnan(v) for v in x):
            assert got.score is None
        else:
            assert got.score == pytest.approx(-0.25 + sum(c * one(x, v) for v, c in support), abs=1e-9)


def test_support_vectors_are_checked(make):
    for vector in ([1.0, 2.0], [1.0, None, 2.0], [1.0, float("nan"), 2.0], None):
        with pytest.raises(ValueError, match="support vectors"):
            kernels.kernel_scorer(kernels.KernelModel(make([(vector, 1.0)], "vector array<double>, coefficient double"), FEATURES))
    with pytest.raises(ValueError, match="kernel must"):
        kernels.kernel_scorer(kernels.KernelModel(make([], "vector array<double>, coefficient double"), FEATURES, "cosine"))
    none = kernels.KernelModel(make([], "vector array<double>, coefficient double"), ("d",), intercept=1.5)
    assert kernels.kernel_scorer(none)(make([(0.0,)], "d double"), "s").first().s == 1.5


def test_ranking_predicts_every_row_once(spark, make):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def predict(x):
        seen.add(1)
        return float(x % 7)
    features = make([(f"p{i:03}", i) for i in range(100)], "player string, x int").repartition(3)
    scorers = {"m": lambda df, out: df.withColumn(out, predict("x"))}
    scored, _ = scoring.score_models(features, scorers, ["player"])
    ranked = ranking.rank_models(scored, players=features)
    assert ranked.count() == 100
    seen.value = 0
    first = ranked.orderBy("pos").first()
    assert (first.player, first.pos) == ("p006", 1) and seen.value == 100
