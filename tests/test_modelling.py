from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eraloom.operators import gates, modelling, neutralize, walkforward
from eraloom.operators.trees import Ensemble as Ensemble_
from eraloom.operators.trees import FlatTree
from eraloom.plans.queries import KnownTree

FEATURES = ["feature_0", "feature_1", "feature_2"]


class Ensemble:
    """Trees whose sum nears the target, tree by tree, up to ``good`` trees, and leaves it then."""

    def __init__(self, n: int, good: int):
        self.trees = [KnownTree({0: 1.0})] * n
        self.treeWeights = [1.0 / good if k < good else 0.5 for k in range(n)]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(600).select(F.col("id").cast("string").alias("id"), (F.col("id") % 12 + 1).cast("int").alias("era_int"), (F.col("id") * 37 % 101 / 101.0).alias("target"))
    return df.select(
        "*", F.col("target").alias("feature_0"), (F.col("target") * 2 + 1).alias("feature_1"), (F.col("id").cast("long") * 11 % 13 / 1.0).alias("feature_2"), (F.col("id").cast("long") % 5 != 0).alias("bench_present")
    )


def test_rounds_grow_only_until_patience_runs_out(rows):
    asked = []

    def fit(train, valid, params, seed):
        asked.append(params.rounds)
        return Ensemble(params.rounds, 30)

    params = modelling.Params(rounds=5_000, patience=10, scan_period=15, features=FEATURES)
    _, found = modelling.fit_and_scan(rows, rows, params, 1, fit)
    assert asked == [20, 40]
    assert found["rounds"] == 40 and found["best_rmse"] < 1e-9  # 10 rounds after the best, the 30th
    assert found["best_iter"] in (15, 30, 40)
    _, found = modelling.fit_and_scan(rows, rows, modelling.replace(params, select_best_by="rmse"), 1, fit)
    assert found["best_iter"] == 30


def test_stopping_round():
    curve = [(1, 3.0), (2, 2.0), (3, 2.5), (4, 2.0), (5, 1.0)]
    assert modelling.stopping_round(curve, 2) == (4, True) and modelling.stopping_round(curve, 3) == (5, False)
    assert modelling.stopping_round([(1, math.nan), (2, math.nan)], 5) == (2, False)


def test_staged_predictions_are_partial_sums(rows, monkeypatch):
    monkeypatch.setattr(modelling, "TREES", 3)
    model = Ensemble(8, 4)
    for point in (1, 3, 4, 8):
        weight = sum(model.treeWeights[:point])
        got = modelling.staged_predictions(model, rows, FEATURES, point)
        assert got.columns == [*rows.columns, f"pred_{point}"]
        assert got.where(F.abs(F.col(f"pred_{point}") - weight * F.col("target")) > 1e-9).isEmpty()
    with pytest.raises(ValueError, match="trees"):
        modelling.staged_predictions(model, rows, FEATURES, 9)


def test_boosted_trees_equal_their_stages(rows):
    """Spark's own prediction is the last stage, and equal seeds give equal first trees."""
    params = modelling.Params(learning_rate=0.3, num_leaves=4, min_leaf=5, rounds=4, patience=2, scan_period=2, features=FEATURES)
    model = modelling.fit_gbt(rows, rows, params, 7)
    last = modelling.staged_predictions(model, rows, FEATURES, 4)
    both = model.transform(modelling.assemble(last, FEATURES))
    assert both.where(F.abs(F.col("prediction") - F.col("pred_4")) > 1e-9).isEmpty()
    more = modelling.fit_gbt(rows, rows, modelling.replace(params, rounds=6), 7)
    assert [t.toDebugString.split("\n", 1)[1] for t in more.trees[:4]] == [t.toDebugString.split("\n", 1)[1] for t in model.trees]


@pytest.mark.parametrize("block", [50, 2])
def test_boosting_in_steps_equals_the_whole_fit(rows, monkeypatch, block):
    """With all features and rows the trees are those of Spark's ensemble, fitted one by one and no further than needed."""
    monkeypatch.setattr(modelling, "TREES", block)
    train, valid = rows.where("era_int <= 8"), rows.where("era_int > 8")
    noisy = lambda df: df.withColumn("target", F.col("target") + F.col("feature_2") * F.col("era_int") / 60)
    train, valid = noisy(train), noisy(valid)
    params = modelling.Params(learning_rate=0.3, num_leaves=4, min_leaf=5, rounds=7, patience=7, feature_fraction=1.0, bagging_fraction=1.0, features=FEATURES)
    whole = modelling.as_ensemble(modelling.fit_gbt(train, valid, params, 7))
    steps = modelling.fit_boosted(train, valid, params, 7)
    assert len(steps.trees) == len(steps.errors) == 7 and steps.treeWeights == whole.treeWeights
    for a, b in zip(steps.trees, whole.trees, strict=True):
        assert a.feature.tolist() == b.feature.tolist() and np.allclose(a.threshold, b.threshold) and np.allclose(a.value, b.value, atol=1e-9)
    curve = dict(map(tuple, modelling.staged_errors(valid, whole, FEATURES).collect()))
    assert all(abs(curve[i] - e) < 1e-9 for i, e in steps.errors)
    by_hand = [r["e"] for k in range(1, 8) for r in modelling.staged_predictions(whole, valid, FEATURES, k).agg(F.sqrt(F.avg(F.pow(F.col(f"pred_{k}") - F.col("target"), F.lit(2)))).alias("e")).collect()]
    assert np.allclose(by_hand, [curve[k] for k in range(1, 8)])


def test_boosting_stops_with_patience_and_leaves_no_tables(spark, rows):
    """Pure noise: the error rises at once, so that patience rounds after the best are the last fitted."""
    import glob

    noise = rows.select("era_int", (F.xxhash64("id") % 100 / 100.0).alias("target"), *FEATURES)
    params = modelling.Params(learning_rate=1.0, num_leaves=8, min_leaf=1, rounds=40, patience=3, scan_period=2, feature_fraction=0.7, bagging_fraction=0.8, features=FEATURES)
    model, found = modelling.fit_and_scan(noise.where("era_int <= 6"), noise.where("era_int > 6"), params, 3)
    best = min(model.errors, key=lambda x: (x[1], x[0]))[0]
    assert len(model.trees) == found["rounds"] == best + 3 < 40
    assert not glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/boosting-*")
    again, _ = modelling.fit_and_scan(noise.where("era_int <= 6").repartition(7), noise.where("era_int > 6"), params, 3)
    assert [t.feature.tolist() for t in again.trees] == [t.feature.tolist() for t in model.trees]
    assert len(modelling.fit_final(noise, params, 4, 3).trees) == 4


def test_features_of_a_round():
    chosen = [modelling.tree_features([f"f{k}" for k in range(20)], 0.3, s) for s in range(5)]
    assert all(len(c) == 6 and c == sorted(c) for c in chosen) and len(set(map(tuple, chosen))) > 1
    assert modelling.tree_features(["a", "b"], 0.01, 1) in ([0], [1])


def test_staged_errors_of_missing_values(spark):
    """Rows without a target count nowhere, a missing feature goes right, no rows give no error."""
    tree = FlatTree(np.array([0, -1, -1]), np.array([0.5, 0, 0]), np.array([1, 0, 0]), np.array([2, 0, 0]), np.array([0.0, 1.0, 3.0]))
    model = Ensemble_([tree, tree], [1.0, 0.5])
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0), (None, 4.0), (1.0, None)], "a double, target double")
    assert [round(r["rmse"], 9) for r in modelling.staged_errors(df, model, ["a"]).orderBy("iter").collect()] == [round((1 / 3) ** 0.5, 9), round(((0.5**2 + 1.5**2 + 0.5**2) / 3) ** 0.5, 9)]
    assert [r["rmse"] for r in modelling.staged_errors(df.limit(0), model, ["a"]).collect()] in ([], [None, None])
    assert [r["pred_2"] for r in modelling.staged_predictions(model, df, ["a"], 2).collect()] == [1.5, 4.5, 4.5, 4.5]


def test_thin_windows_are_never_fitted(rows):
    fitted = []

    def fit(train, valid, params, seed):
        fitted.append(valid.agg(F.min("era_int")).first()[0])
        return Ensemble(2, 2)

    params = modelling.Params(rounds=2, patience=1, scan_period=1, features=FEATURES)
    windows = walkforward.build_windows(rows, 4, 1)
    some = rows.withColumn("bench_present", F.col("bench_present") & (F.col("era_int") > 7))
    out = modelling.collect_oof(some, windows, params, 1, fit, min_rows=100, min_eras=4)
    assert fitted == [9] and {r[0] for r in out.select("window_id").distinct().collect()} == {2}
    assert out.where("not bench_present").isEmpty()
    with pytest.raises(ValueError, match="covered"):
        modelling.collect_oof(some, windows, params, 1, fit, min_rows=10_000)


def test_ensemble_resumes_and_scores(spark, rows):
    fit = lambda train, valid, params, seed: Ensemble(2, 2)
    params = modelling.Params(rounds=2, patience=1, scan_period=1, features=FEATURES)
    done = spark.createDataFrame([(1,)], "seed int")
    models, members = modelling.train_ensemble(rows, rows, params, [1, 2], done, fit)
    assert list(models) == [2] and [m["seed"] for m in members] == [2]
    scored = modelling.score_ensemble(rows, {"a": (KnownTree({0: 1.0}), ["feature_2", "feature_0"]), "b": (KnownTree({1: 1.0}), FEATURES)})
    assert scored.where(F.abs(F.col("prediction") - (F.col("feature_2") + F.col("feature_1")) / 2) > 1e-5).isEmpty()


def test_best_corr_iteration(spark):
    curve = lambda rows: tuple(modelling.best_corr_iteration(spark.createDataFrame(rows, "iter int, corr double")).first())
    assert curve([(100, 0.1), (200, 0.3), (300, 0.3), (400, math.nan)]) == (200, 0.3)
    assert curve([(100, math.nan), (200, math.nan)]) == (100, -math.inf)


def test_profiles():
    assert modelling.Params.resolve("balanced", rounds=None, num_leaves=31).rounds == 2500
    assert modelling.Params.resolve().patience == 300
    with pytest.raises(ValueError, match="profile"):
        modelling.Params.resolve("none")


def test_features_are_chosen_by_seed(spark, rows):
    names = [f"f{k}" for k in range(30)]
    table = spark.createDataFrame([(n,) for n in names], "feature string")
    chosen = neutralize.chosen_features(names, 7, 3)
    assert sorted(chosen) == [r["feature"] for r in gates.choose_features(table, 7, 3).collect()] and len(chosen) == 7
    config = neutralize.PostprocessConfig(0.5, 0.5, ("feature_1",), feature_neutralize_prop=1.0, feature_neutralize_n_features=1, feature_neutralize_seed=3)
    one = neutralize.chosen_features(FEATURES, 1, 3)
    full = neutralize.postprocess(rows.withColumn("prediction", F.col("target")), config, features=FEATURES)
    only = neutralize.postprocess(rows.withColumn("prediction", F.col("target")), config, features=one)
    assert sorted(map(tuple, full.select("id", "submission").collect())) == sorted(map(tuple, only.select("id", "submission").collect()))
