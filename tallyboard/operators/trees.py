"""Scores of tree ensembles, walked in the JVM.

An ensemble is a flat node table, one row per node: (tree, node, feature, threshold, low,
high, missing, value). Node 0 is the root. An inner node sends a row to ``low`` if the
feature is at most the threshold, else to ``high``; rows without the feature (null or NaN)
go to ``missing``, or as if the feature were above every threshold where that is null. A
leaf has no feature and gives its value. Trees weigh ``weight``.

The nodes of all trees become arrays of one row, which a subquery hands to the plan, after
their size was checked; a fold over the levels walks one tree, a fold over the trees sums
them. The table may hold any number of rows, and no Python runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyboard.operators.scoring import Scorer

NODES = "tree int, node int, feature string, threshold double, low int, high int, missing int, value double"
NODE_BYTES = 40  # of a node in the arrays
MODEL_BYTES = 64 * 1024 * 1024

# How the values of trees make a score: their mean (a forest), their weighted sum on a start
# (boosting), or their weighted median (boosting by resampling).
COMBINATIONS = ("mean", "sum", "median")


class ModelError(ValueError):
    """A node table is no ensemble of trees, or too large to hand to every task."""


@dataclass(frozen=True)
class TreeModel:
    """Nodes (NODES), the weights of trees in their order (all 1 if none are given), and how they combine."""

    nodes: DataFrame
    features: tuple[str, ...]
    combine: str = "mean"
    start: float = 0.0
    weights: tuple[float, ...] = ()

    def checked(self) -> tuple[int, int]:
        """Number of trees, and levels below the root of the deepest; raises if the nodes are no trees.

        One job over the node table, whose size is the model's.
        """
        if self.combine not in COMBINATIONS:
            raise ModelError(f"combine must be one of {COMBINATIONS}")
        inner = F.col("feature").isNotNull()
        # Children come after their parent, so that every walk ends; depths follow from that order.
        ordered = (F.col("low") > F.col("node")) & (F.col("high") > F.col("node")) & F.coalesce(F.col("missing") > F.col("node"), F.lit(True))
        row = self.nodes.groupBy("tree").agg(
            F.count(F.lit(1)).alias("n"), F.max("node").alias("last"), F.count_if(inner & ~F.coalesce(ordered, F.lit(False))).alias("bad"),
            F.count_if(inner & ~F.col("feature").isin(list(self.features))).alias("unknown"),
            F.count_if(~inner & F.col("value").isNull()).alias("empty"), F.count_distinct("node").alias("distinct"),
            F.max(F.greatest("low", "high", "missing")).alias("furthest")).agg(
            F.count(F.lit(1)).alias("trees"), F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("unknown").alias("unknown"),
            F.sum("empty").alias("empty"), F.count_if((F.col("distinct") != F.col("n")) | (F.col("last") + 1 != F.col("n"))).alias("gaps"),
            F.count_if(F.col("furthest") > F.col("last")).alias("outside"), F.min("tree").alias("first"), F.max("tree").alias("last")).first()
        if not row["trees"]:
            raise ModelError("the model has no tree")
        for what in ("bad", "unknown", "empty", "gaps", "outside"):
            if row[what]:
                raise ModelError(f"{row[what]} nodes or trees are wrong: {what}")
        if row["first"] != 0 or row["last"] + 1 != row["trees"]:
            raise ModelError("trees must be numbered from 0 without gaps")
        if self.weights and len(self.weights) != row["trees"]:
            raise ModelError(f"{len(self.weights)} weights for {row['trees']} trees")
        if row["n"] * NODE_BYTES > MODEL_BYTES:
            raise ModelError(f"{row['n']} nodes take more than {MODEL_BYTES} bytes; score with fewer trees at a time")
        return row["trees"], self._depth()

    def _depth(self) -> int:
        """Levels below the root; the inner nodes, whose number was checked, come to the driver."""
        inner = self.nodes.where(F.col("feature").isNotNull()).select("tree", "node", "low", "high", "missing")
        depth: dict[tuple[int, int], int] = {}
        for tree, node, *children in sorted((tuple(r) for r in inner.collect()), key=lambda r: r[:2]):
            below = depth.get((tree, node), 0) + 1  # children come after their parent
            for child in children:
                if child is not None:
                    depth[tree, child] = max(below, depth.get((tree, child), 0))
        return max(depth.values(), default=0)

    def _arrays(self) -> Column:
        """One struct of arrays: nodes of all trees one after the other, with absolute numbers, and the root of each tree."""
        numbers = F.create_map(*[F.lit(x) for i, f in enumerate(self.features) for x in (f, i)])
        sizes = self.nodes.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct(
            "node", numbers[F.col("feature")].alias("f"), F.col("threshold").alias("t"), F.col("low").alias("l"), F.col("high").alias("h"),
            F.coalesce("missing", "high").alias("m"), F.col("value").alias("v")))).alias("nodes"))
        trees = sizes.agg(F.array_sort(F.collect_list(F.struct("tree", "nodes"))).alias("trees"))
        begin = F.aggregate("trees", F.array(F.lit(0)), lambda done, t: F.concat(done, F.array(F.element_at(done, -1) + F.size(t["nodes"]))))
        trees = trees.withColumn("begin", begin)

        def flat(name: str, moved: bool = False) -> Column:
            return F.flatten(F.transform("trees", lambda t, i: F.transform(t["nodes"], lambda n: n[name] + F.get(F.col("begin"), i) if moved else n[name])))
        # Children of a leaf are null, also after they are moved.
        return trees.select(F.struct(flat("f").alias("f"), flat("t").alias("t"), flat("l", True).alias("l"), flat("h", True).alias("h"),
                                     flat("m", True).alias("m"), flat("v").alias("v"), F.slice("begin", 1, F.size("trees")).alias("roots"))).scalar()


def tree_scorer(model: TreeModel) -> Scorer:
    """Adds the score of a tree ensemble."""
    trees, depth = model.checked()

    def score(df: DataFrame, out: str) -> DataFrame:
        held, values = f"{out}__nodes", f"{out}__x"
        x = F.array(*[F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None).cast("double")) for f in model.features])
        wide = df.withColumns({held: model._arrays(), values: x})
        nodes = F.col(held)

        def walk(at: Column, _: Column) -> Column:
            feature = F.get(nodes["f"], at)
            here = F.get(F.col(values), feature)
            return F.when(feature.isNull(), at).when(here.isNull(), F.get(nodes["m"], at)).otherwise(
                F.when(here <= F.get(nodes["t"], at), F.get(nodes["l"], at)).otherwise(F.get(nodes["h"], at)))

        def leaf(root: Column) -> Column:
            return F.get(nodes["v"], F.aggregate(F.sequence(F.lit(1), F.lit(depth)), root, walk) if depth else root)
        found = F.transform(nodes["roots"], leaf)
        return wide.withColumn(out, _combined(found, model, trees)).drop(held, values)
    return score


def _combined(values: Column, model: TreeModel, trees: int) -> Column:
    weights = model.weights or (1.0,) * trees
    zero, start = F.lit(0.0), F.lit(float(model.start))
    if model.combine == "mean":
        return F.aggregate(values, zero, lambda s, v: s + v) / F.lit(float(trees))
    heavy = F.array(*[F.lit(float(w)) for w in weights])
    if model.combine == "sum":
        return F.aggregate(F.zip_with(values, heavy, lambda v, w: v * w), start, lambda s, v: s + v)
    # The least value at which half of the weight is reached; ties in value by the trees' order.
    half = 0.5 * sum(weights)
    ordered = F.array_sort(F.transform(values, lambda v, i: F.struct(v.alias("v"), i.alias("i"), F.get(heavy, i).alias("w"))))
    state = F.struct(zero.alias("seen"), F.lit(None).cast("double").alias("found"))
    done = F.aggregate(ordered, state, lambda s, n: F.struct(
        (s["seen"] + n["w"]).alias("seen"), F.when(s["found"].isNull() & (s["seen"] + n["w"] >= half), n["v"]).otherwise(s["found"]).alias("found")))
    return done["found"]


def save_trees(model: TreeModel, path: str) -> None:
    """Store a model as Parquet: its nodes, and one row that says how they combine."""
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    row = [(list(model.features), model.combine, model.start, list(model.weights))]
    model.nodes.sparkSession.createDataFrame(row, "features array<string>, combine string, start double, weights array<double>") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/model")


def load_trees(spark: SparkSession, path: str) -> TreeModel:
    row = spark.read.parquet(f"{path}/model").first()
    return TreeModel(spark.read.schema(NODES).parquet(f"{path}/nodes"), tuple(row["features"]), row["combine"], row["start"], tuple(row["weights"]))


def nodes_of_trees(spark: SparkSession, trees: Sequence, features: Sequence[str]) -> DataFrame:
    """Node table of fitted Spark ML regression trees, such as ``forest.trees``, on continuous features."""
    rows, sizes = [], [0] * len(trees)

    def add(tree: int, node) -> int:
        at = sizes[tree]
        sizes[tree] += 1
        rows.append([tree, at, None, None, None, None, None, node.prediction()])
        if node.subtreeDepth():
            split = node.split()
            rows[-1][2:4] = features[split.featureIndex()], split.threshold()
            mine = rows[-1]
            mine[4] = add(tree, node.leftChild())
            mine[5] = add(tree, node.rightChild())
        return at
    for i, t in enumerate(trees):
        add(i, t._call_java("rootNode"))
    return spark.createDataFrame([tuple(r) for r in rows], NODES)
