import operator
import pickle
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tallyboard.operators import scoring
from tallyboard.session import scratch_path

from .conftest import rows

FEATURES = ["PTS_TOTAL", "WS/48_ADVANCED"]


@pytest.fixture
def table(make):
    return make([(f"p{i}", float(i), float(i * i % 7)) for i in range(20)], "PLAYER string, PTS_TOTAL double, `WS/48_ADVANCED` double")


def test_scaler_uses_population_deviation_and_survives_storage(spark, table):
    scaler = scoring.Scaler.fit(table, FEATURES)
    values = np.arange(20.0)
    assert scaler.mean[0] == values.mean() and scaler.std[0] == pytest.approx(values.std())
    path = scratch_path(spark, "scaler")
    scaler.save(spark, path)
    assert scoring.Scaler.load(spark, path) == scaler
    got = [r[0] for r in scaler.transform(table).select("PTS_TOTAL").collect()]
    assert got == pytest.approx(list((values - values.mean()) / values.std()))


def test_constant_features_are_only_centred(make):
    df = make([(3.0,), (3.0,)], "x double")
    assert rows(scoring.Scaler.fit(df, ["x"]).transform(df)) == [(0.0,), (0.0,)]
    assert rows(scoring.standardize(df, ["x"])) == [(0.0,), (0.0,)]


def test_standardize_reads_its_input_once(spark, plan):
    df = spark.range(100).selectExpr("id % 9 AS k", "id AS x").groupBy("k").agg(F.sum("x").alias("x"))
    got = scoring.standardize(df, ["x"])
    got.collect()
    assert "ReusedExchange" in plan(got, "simple") or "ReusedSubquery" in plan(got, "simple")


def test_expression_and_linear_scorers(table):
    scorers = {"a": scoring.expression_scorer("PTS_TOTAL * 2"),
               "b": scoring.linear_scorer({"PTS_TOTAL": 1.0, "WS/48_ADVANCED": 10.0}, 0.5)}
    got, skipped = scoring.score_models(table.limit(3), scorers, ["PLAYER"])
    assert skipped == {}
    assert rows(got.where("PLAYER = 'p2'")) == [("p2", 0, "a", 4.0), ("p2", 1, "b", 42.5)]


def test_failing_models_raise_or_are_reported(table):
    scorers = {"a": scoring.expression_scorer("no_such_column"), "b": scoring.expression_scorer("PTS_TOTAL")}
    with pytest.raises(Exception, match="no_such_column"):
        scoring.score_models(table, scorers, ["PLAYER"])
    got, skipped = scoring.score_models(table, scorers, ["PLAYER"], on_error="skip")
    assert list(skipped) == ["a"]
    assert {(r.mo, r.model) for r in got.collect()} == {(1, "b")}
    with pytest.raises(ValueError, match="no model"):
        scoring.score_models(table, {"a": scorers["a"]}, ["PLAYER"], on_error="skip")


@pytest.mark.parametrize("kind, options", [(LinearRegression, {}), (RandomForestRegressor, {"numTrees": 3, "seed": 1})])
def test_stored_pipelines_score(spark, table, kind, options):
    from pyspark.ml.feature import VectorAssembler
    plain = table.select(F.col("PTS_TOTAL").alias("f0"), F.col("`WS/48_ADVANCED`").alias("f1"),
                         (F.col("PTS_TOTAL") * 2).alias("y"))
    train = VectorAssembler(inputCols=["f0", "f1"], outputCol="features").transform(plain)
    path = scratch_path(spark, "model")
    Pipeline(stages=[kind(labelCol="y", **options)]).fit(train).write().save(path)
    got, _ = scoring.score_models(table, {"m": scoring.load_pipeline_scorer(path, FEATURES)}, ["PLAYER"])
    best = got.orderBy(F.desc("share"), "PLAYER").first()
    assert got.count() == 20 and got.columns == ["PLAYER", "mo", "model", "share"]
    if kind is LinearRegression:
        assert (best.PLAYER, best.share) == ("p19", pytest.approx(38.0))


def test_pickled_estimator_scores_from_a_file(spark, table, tmp_path):
    model = SimpleNamespace(predict=operator.methodcaller("sum", axis=1))
    path = tmp_path / "SVM.dat"
    path.write_bytes(pickle.dumps(model))
    got, _ = scoring.score_models(table, {"SVM": scoring.load_pickled_scorer(spark, str(path), FEATURES)}, ["PLAYER"])
    assert dict(rows(got.select("PLAYER", "share")))["p5"] == 5.0 + 25 % 7


def test_model_files_of_one_name_are_told_apart(spark, table, tmp_path):
    scorers = {}
    for weight, folder in ((1.0, "a"), (10.0, "b")):
        (tmp_path / folder).mkdir()
        path = tmp_path / folder / "SVM.dat"
        path.write_bytes(pickle.dumps(SimpleNamespace(predict=operator.methodcaller("dot", np.array([weight, 0.0])))))
        scorers[folder] = scoring.load_pickled_scorer(spark, str(path), FEATURES)
    got, _ = scoring.score_models(table, scorers, ["PLAYER"])
    assert {(r.model, r.share) for r in got.where("PLAYER = 'p5'").collect()} == {("a", 5.0), ("b", 50.0)}


@pytest.mark.parametrize("kind", ["bytes", "file"])
def test_a_model_that_fails_while_predicting(spark, table, tmp_path, kind):
    payload = pickle.dumps(SimpleNamespace(predict=operator.methodcaller("no_such_method")))
    (tmp_path / "bad.dat").write_bytes(payload)
    bad = (scoring.pickled_scorer(spark, payload, FEATURES) if kind == "bytes"
           else scoring.load_pickled_scorer(spark, str(tmp_path / "bad.dat"), FEATURES))
    good = {"a": scoring.expression_scorer("PTS_TOTAL"), "c": scoring.linear_scorer({"PTS_TOTAL": 2.0})}
    scorers = {"a": good["a"], "bad": bad, "c": good["c"]}
    with pytest.raises(Exception, match="no_such_method"):
        scoring.score_models(table, scorers, ["PLAYER"])[0].collect()
    got, skipped = scoring.score_models(table, scorers, ["PLAYER"], on_error="skip")
    assert list(skipped) == ["bad"] and "no_such_method" in skipped["bad"]
    want, _ = scoring.score_models(table, good, ["PLAYER"])
    assert rows(got.select("PLAYER", "model", "share")) == rows(want.select("PLAYER", "model", "share"))
    assert {(r.mo, r.model) for r in got.collect()} == {(0, "a"), (2, "c")}


def test_scorers_load_by_model_name(spark, table, tmp_path):
    (tmp_path / "Random Forest.dat").write_bytes(pickle.dumps(SimpleNamespace(predict=operator.methodcaller("sum", axis=1))))
    with pytest.raises(Exception):
        scoring.load_scorers(spark, str(tmp_path), ["SVM", "Random Forest"], FEATURES)
    scorers, skipped = scoring.load_scorers(spark, str(tmp_path), ["SVM", "Random Forest"], FEATURES, on_error="skip")
    assert list(scorers) == ["Random Forest"] and list(skipped) == ["SVM"]
    assert scoring.score_models(table, scorers, ["PLAYER"])[0].count() == 20


def test_feature_lists_keep_their_order(spark):
    path = scratch_path(spark, "features")
    scoring.save_features(spark, ["b", "a", "WS/48_ADVANCED"], path)
    assert scoring.load_features(spark, path) == ["b", "a", "WS/48_ADVANCED"]


def test_nan_scores_count_as_missing(make):
    df = make([("a", float("nan")), ("b", 1.0)], "PLAYER string, x double")
    got, _ = scoring.score_models(df, {"m": scoring.expression_scorer("x")}, ["PLAYER"])
    assert rows(got) == sorted([("a", 0, "m", None), ("b", 0, "m", 1.0)], key=repr)
