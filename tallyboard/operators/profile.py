"""Rows and non-null counts of every column at every step, gathered while the steps run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROFILE = "step string, place int, column string, rows bigint, non_null bigint"


def _counts(df: DataFrame) -> list:
    """The names of metrics are places, so that columns may have any names."""
    return [F.count(F.lit(1)).alias("rows"), *[F.count(F.col("`" + c.replace("`", "``") + "`")).alias(f"c{i}") for i, c in enumerate(df.columns)]]


def _lines(step: str, columns: list[str], metrics: dict) -> list[tuple]:
    return [(step, i, c, metrics["rows"], metrics[f"c{i}"]) for i, c in enumerate(columns)]


class StepProfile:
    """Watches the steps of a job.

    ``step`` returns the table to go on with. The counts are there once an action has run
    over the steps; a step that the action's plan does not contain has none and raises. Each
    step is one set of metrics, and no table is read for it. The optimiser may not move
    filters or drop columns across a watched step, so watch steps at which a profile is wanted.
    """

    def __init__(self):
        self.watches: list[tuple[str, list[str], Observation]] = []

    def step(self, df: DataFrame, name: str) -> DataFrame:
        watch = Observation()
        self.watches.append((name, df.columns, watch))
        return df.observe(watch, *_counts(df))

    def table(self, spark: SparkSession) -> DataFrame:
        """(step, place, column, rows, non_null): one row per step and column."""
        lines = [line for name, columns, watch in self.watches for line in _lines(name, columns, watch.get)]
        return spark.createDataFrame(lines, PROFILE)


class StreamProfile(StreamingQueryListener):
    """The same for streams: metrics of watched steps, batch by batch.

    Add it with ``spark.streams.addListener``; ``lines`` grows by one row per batch, step and column.
    """

    def __init__(self):
        self.steps: dict[str, list[str]] = {}
        self.lines: list[tuple] = []  # batch, then as in a profile

    def step(self, df: DataFrame, name: str) -> DataFrame:
        self.steps[name] = df.columns
        return df.observe(name, *_counts(df))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            if name in self.steps:
                self.lines += [(event.progress.batchId, *line) for line in _lines(name, self.steps[name], row.asDict())]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.lines, f"batch_id bigint, {PROFILE}")
