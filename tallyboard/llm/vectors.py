"""What the two vector searches share: usable vectors, and candidates meeting queries in streamed groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallyboard.llm.common import col
from tallyboard.session import scratch_table


def usable(vectors: DataFrame, id_col: str, vector: str, zero_too: bool) -> DataFrame:
    """(id, vec array<double>) of rows that take part, written once.

    Left out are rows without an id, null vectors, vectors with a null or non-finite
    component, zero vectors unless asked for, and vectors whose length is not the commonest
    one (of equally common lengths, the larger).
    """
    whole = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(col(id_col).cast("bigint").alias("id"), col(vector).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & whole & (F.size("vec") > 0))
    if not zero_too:
        rows = rows.where(F.exists("vec", lambda x: x != 0))
    rows = scratch_table(rows, "vectors")
    length = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    return rows.where(F.size("vec") == (length["d"] if length else 0))


def is_query(id_: Column, every: int) -> Column:
    return F.pmod(id_, F.lit(every)) == 0


def meetings(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame | None, pd.DataFrame]]:
    """(candidates, some queries) of rows sorted by ``key`` and ``asks`` (candidates 0, queries 1).

    Candidates of a key come whole, with the first of its queries (None with later ones);
    queries come as the batches have them, so any number of them can meet one group.
    """
    key, group, handed = None, [], False
    for batch in batches:
        place = batch["key"].to_numpy(), batch["asks"].to_numpy()
        cuts = np.flatnonzero((place[0][1:] != place[0][:-1]) | (place[1][1:] != place[1][:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(batch)]):
            part = batch.iloc[a:b]
            if not len(part):
                continue
            if place[0][a] != key:
                key, group, handed = place[0][a], [], False
            if not place[1][a]:
                group.append(part)
            elif group or handed:
                yield (None if handed else pd.concat(group)), part
                group, handed = [], True


def stacked(rows: pd.DataFrame) -> np.ndarray:
    return np.stack(rows["vec"].to_numpy()).astype(np.float64, copy=False)


def laid_out(rows: DataFrame, keys: int, per_core: int = 4) -> DataFrame:
    """Rows with keys 0 to ``keys`` - 1 in partitions that hold as many keys each, candidates before queries."""
    spark = rows.sparkSession
    wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), per_core * spark.sparkContext.defaultParallelism)
    return rows.repartitionById(min(keys, wide), (F.col("key") % min(keys, wide)).cast("int")).sortWithinPartitions("key", "asks", "id")
