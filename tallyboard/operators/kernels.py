"""Scores of kernel machines: a sum of kernels over support vectors, in the JVM.

The support vectors are a table (vector array<double>, coefficient double). They reach every
task as one array, a block whose bytes were measured first. Vectors beyond that bound are
dealt to several blocks; then the rows are scored block after block, each pass adding its
sum to a written table, so that a task holds one block however many there are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyboard.operators.scoring import Scorer
from tallyboard.session import scratch_table

BLOCK_BYTES = 32 * 1024 * 1024
KERNELS = ("rbf", "linear", "poly")


@dataclass(frozen=True)
class KernelModel:
    """Support vectors over ``features``, the kernel and its parameters, and the intercept."""

    support: DataFrame
    features: tuple[str, ...]
    kernel: str = "rbf"
    gamma: float = 1.0
    degree: int = 3
    offset: float = 0.0
    intercept: float = 0.0


def measured_blocks(model: KernelModel, block_bytes: int) -> int:
    """Blocks that the support vectors take; raises for vectors of another length, or with missing values."""
    if model.kernel not in KERNELS:
        raise ValueError(f"kernel must be one of {KERNELS}")
    width = len(model.features)
    whole = (F.size("vector") == width) & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v)) & F.col("coefficient").isNotNull()
    row = model.support.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(whole, F.lit(False))).alias("bad")).first()
    if row["bad"]:
        raise ValueError(f"{row['bad']} support vectors do not hold {width} numbers and a coefficient")
    return max(1, -(-row["n"] * (8 * width + 40) // block_bytes))


def _kernel(model: KernelModel, x: Column, v: Column) -> Column:
    zero = F.lit(0.0)
    if model.kernel == "rbf":
        return F.exp(F.lit(-float(model.gamma)) * F.aggregate(F.zip_with(x, v, lambda a, b: (a - b) * (a - b)), zero, lambda s, d: s + d))
    dot = F.aggregate(F.zip_with(x, v, lambda a, b: a * b), zero, lambda s, d: s + d)
    return dot if model.kernel == "linear" else F.pow(F.lit(float(model.gamma)) * dot + F.lit(float(model.offset)), F.lit(float(model.degree)))


def _block(block: DataFrame) -> Column:
    """The vectors of a block, in an order of their own, so that sums do not depend on how they lie."""
    return block.agg(F.array_sort(F.collect_list(F.struct("vector", "coefficient"))).alias("block")).scalar()


def kernel_scorer(model: KernelModel, block_bytes: int = BLOCK_BYTES) -> Scorer:
    """Adds the score of a kernel machine; a row with a missing feature has none."""
    blocks = measured_blocks(model, block_bytes)
    support = model.support.select("vector", F.col("coefficient").cast("double").alias("coefficient"))
    if blocks > 1:
        # Equal shares by position: a hash could deal a block more than its bound.
        number = F.row_number().over(Window.partitionBy("__part").orderBy("vector", "coefficient"))
        parts = support.withColumn("__part", F.pmod(F.xxhash64("vector", "coefficient"), F.lit(64)))
        support = scratch_table(parts.withColumn("__block", F.pmod(number + F.col("__part"), F.lit(blocks))).drop("__part"), "support")

    def score(df: DataFrame, out: str) -> DataFrame:
        x, held = f"{out}__x", f"{out}__block"
        features = F.array(*[F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None).cast("double")) for f in model.features])
        known = F.forall(x, lambda v: v.isNotNull())
        scored = df.withColumns({x: features, out: F.lit(float(model.intercept))})
        for b in range(blocks):
            block = support.where(F.col("__block") == b) if blocks > 1 else support
            total = F.aggregate(held, F.lit(0.0), lambda s, v: s + v["coefficient"] * _kernel(model, F.col(x), v["vector"]))
            scored = scored.withColumn(held, _block(block)).withColumn(out, F.when(known, F.col(out) + total)).drop(held)
            if b + 1 < blocks:
                scored = scratch_table(scored, "partial_scores")
        return scored.drop(x)
    return score
