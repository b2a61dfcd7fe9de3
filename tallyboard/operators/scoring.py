"""Feature scaling and scoring of candidates with several registered models."""

from __future__ import annotations

import logging
import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark import SparkFiles
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyboard.functions import nan_to_null
from tallyboard.session import scratch_path, scratch_table

log = logging.getLogger(__name__)

# A scorer adds one double column of the given name to a table of features.
Scorer = Callable[[DataFrame, str], DataFrame]


def _sum(terms: Sequence[Column], start: float = 0.0) -> Column:
    total = F.lit(start)
    for t in terms:
        total = total + t
    return total


# --- scaling -----------------------------------------------------------------

@dataclass(frozen=True)
class Scaler:
    """Stored mean and population standard deviation per feature."""

    features: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str]) -> Scaler:
        row = df.agg(*[F.avg(F.col(f"`{f}`")).alias(f"m{i}") for i, f in enumerate(features)],
                     *[F.stddev_pop(F.col(f"`{f}`")).alias(f"s{i}") for i, f in enumerate(features)]).first()
        return cls(tuple(features), tuple(row[f"m{i}"] for i in range(len(features))),
                   tuple(row[f"s{i}"] for i in range(len(features))))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, *r) for i, r in enumerate(zip(self.features, self.mean, self.std))]
        spark.createDataFrame(rows, "i int, feature string, mean double, std double") \
            .coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Scaler:
        rows = spark.read.parquet(path).orderBy("i").collect()  # one row per feature
        return cls(tuple(r["feature"] for r in rows), tuple(r["mean"] for r in rows),
                   tuple(r["std"] for r in rows))

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace each feature by its distance from the mean in standard deviations."""
        return df.withColumns({f: (F.col(f"`{f}`") - F.lit(m)) / F.lit(s or 1.0)
                               for f, m, s in zip(self.features, self.mean, self.std)})


def standardize(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Scale by the table's own moments, lazily: one aggregate shared by all features."""
    def z(f: str) -> Column:
        mean, std = df.agg(F.avg(f)).scalar(), df.agg(F.stddev_pop(f)).scalar()
        return (F.col(f) - mean) / F.when(std == 0, F.lit(1.0)).otherwise(std)
    return df.withColumns({f: z(f) for f in features})


# --- scorers -----------------------------------------------------------------

def expression_scorer(expression: str) -> Scorer:
    """Score by a SQL expression over the feature columns."""
    return lambda df, out: df.withColumn(out, F.expr(expression).cast("double"))


def linear_scorer(weights: Mapping[str, float], intercept: float = 0.0) -> Scorer:
    def score(df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, _sum([F.col(f"`{f}`") * F.lit(float(w)) for f, w in weights.items()], intercept))
    return score


def pipeline_scorer(model: PipelineModel, features: Sequence[str], prediction: str = "prediction") -> Scorer:
    """Score by a fitted Spark ML pipeline that reads a vector column ``features``."""
    def score(df: DataFrame, out: str) -> DataFrame:
        keep = [F.col(f"`{c}`") for c in df.columns]
        # The assembler reads dots and slashes in names as paths, so it gets plain names.
        plain = {f"__f{i}": F.col(f"`{f}`").cast("double") for i, f in enumerate(features)}
        vectors = VectorAssembler(inputCols=list(plain), outputCol="features").transform(df.withColumns(plain))
        return model.transform(vectors).select(*keep, F.col(prediction).alias(out))
    return score


def load_pipeline_scorer(path: str, features: Sequence[str]) -> Scorer:
    return pipeline_scorer(PipelineModel.load(path), features)


def _predicting(estimator: Callable[[], object], features: Sequence[str]) -> Scorer:
    """Scorer of an estimator with a ``predict(matrix)`` method, batch by batch; each task gets the estimator once."""

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = estimator()
        for batch in batches:
            yield pd.Series(model.predict(batch.to_numpy(dtype=float)))

    def score(df: DataFrame, out: str) -> DataFrame:
        columns = [F.col(f"`{f}`").cast("double").alias(f"f{i}") for i, f in enumerate(features)]
        return df.withColumn(out, predict(F.struct(*columns)))
    return score


def pickled_scorer(spark: SparkSession, payload: bytes, features: Sequence[str]) -> Scorer:
    """Score by a pickled estimator that the caller holds in memory.

    Unpickling runs code: give it only models you made yourself.
    """
    shared = spark.sparkContext.broadcast(pickle.loads(payload))  # each worker unpacks it once
    return _predicting(lambda: shared.value, features)


def _opening(name: str) -> Callable[[], object]:
    """Opens a file of the job. The code travels with the job."""
    def model() -> object:
        with open(SparkFiles.get(name), "rb") as f:
            return pickle.load(f)
    return model


def load_pickled_scorer(spark: SparkSession, path: str, features: Sequence[str]) -> Scorer:
    """Score by a pickled estimator in a file, of any size.

    The file travels as a file of the job, past the driver's memory, and each task opens
    it once. Unpickling runs code: give it only files you made yourself.
    """
    hadoop = spark._jsc.hadoopConfiguration()
    source = spark._jvm.org.apache.hadoop.fs.Path(path)
    # Files of a job are told apart by name, so every model gets a name of its own.
    target = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "model"))
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        source.getFileSystem(hadoop), source, target.getFileSystem(hadoop), target, False, hadoop)
    spark.sparkContext.addFile(target.toString())
    name = target.getName()
    return _predicting(_opening(name), features)


# --- scoring -----------------------------------------------------------------

def save_features(spark: SparkSession, features: Sequence[str], path: str) -> None:
    spark.createDataFrame(list(enumerate(features)), "i int, feature string") \
        .coalesce(1).write.mode("overwrite").parquet(path)


def load_features(spark: SparkSession, path: str) -> list[str]:
    return [r["feature"] for r in spark.read.parquet(path).orderBy("i").collect()]  # one row per feature


def load_scorers(spark: SparkSession, folder: str, models: Sequence[str], features: Sequence[str],
                 on_error: str = "raise") -> tuple[dict[str, Scorer], dict[str, str]]:
    """Scorers of the named models, and the models skipped with the reason.

    ``{folder}/{model}.dat`` is a pickled estimator, ``{folder}/{model}`` a stored
    Spark ML pipeline.
    """
    scorers: dict[str, Scorer] = {}
    skipped: dict[str, str] = {}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dat").load(folder)
    pickled = {unquote(r["path"]).rsplit("/", 1)[-1] for r in files.select("path").collect()}  # one row per model
    for model in models:
        try:
            scorers[model] = (load_pickled_scorer(spark, f"{folder}/{model}.dat", features) if f"{model}.dat" in pickled
                              else load_pipeline_scorer(f"{folder}/{model}", features))
        except Exception as e:
            if on_error != "skip":
                raise
            log.warning("model %s skipped: %s", model, e)
            skipped[model] = str(e)
    return scorers, skipped


def score_models(df: DataFrame, scorers: Mapping[str, Scorer], keys: Sequence[str],
                 on_error: str = "raise") -> tuple[DataFrame, dict[str, str]]:
    """Long table (keys, mo, model, share) of every model's score, and the models skipped.

    Scorers add columns side by side, so the features are read once; the columns
    are then turned into rows. A NaN score counts as missing.

    With ``on_error="skip"`` a model that fails, when it is planned or while it
    predicts, is reported in the second result and has no scores at all. To know
    that, features and each model's scores are written in turn.
    """
    if on_error == "skip":
        return _score_one_by_one(df, scorers, keys)
    wide, added = df, []
    for mo, (model, scorer) in enumerate(scorers.items()):
        wide = scorer(wide, f"__score{mo}")
        added += [F.lit(mo), F.lit(model), nan_to_null(F.col(f"__score{mo}").cast("double"))]
    if not added:
        raise ValueError("no model could score")
    return wide.select(*keys, F.stack(F.lit(len(scorers)), *added).alias("mo", "model", "share")), {}


def _score_one_by_one(df: DataFrame, scorers: Mapping[str, Scorer], keys: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    features = scratch_table(df, "features")
    scores: list[DataFrame] = []
    skipped: dict[str, str] = {}
    for mo, (model, scorer) in enumerate(scorers.items()):
        try:
            scored = scorer(features, "__score").select(
                *keys, F.lit(mo).alias("mo"), F.lit(model).alias("model"), nan_to_null(F.col("__score").cast("double")).alias("share"))
            scores.append(scratch_table(scored, "scores"))
        except Exception as e:
            log.warning("model %s skipped: %s", model, e)
            skipped[model] = str(e)
    if not scores:
        raise ValueError("no model could score")
    return reduce(DataFrame.unionByName, scores), skipped
