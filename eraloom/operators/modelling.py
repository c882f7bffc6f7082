"""Boosted-tree ensembles on Spark ML, staged prediction and iteration choice."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import partial, reduce

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eraloom.operators.metrics import era_corr
from eraloom.operators.resume import pending
from eraloom.operators.trees import Ensemble, as_ensemble, flatten, predict, staged_at, staged_errors
from eraloom.operators.walkforward import summarize, train_rows
from eraloom.plans.scratch import materialize_at, remove, scratch_path, side_by_side

FitFn = Callable[[DataFrame, DataFrame, "Params", int], "Model | Ensemble"]


@dataclass(frozen=True)
class Params:
    """Learning rate, leaves, feature and row shares, smallest leaf, rounds and patience."""

    learning_rate: float = 0.02
    num_leaves: int = 128
    feature_fraction: float = 0.7
    bagging_fraction: float = 0.8
    min_leaf: int = 1000
    rounds: int = 5000
    patience: int = 300
    scan_period: int = 100
    select_best_by: str = "corr"
    features: list[str] = field(default_factory=list)

    @classmethod
    def resolve(cls, profile: str = "full", **settings) -> Params:
        """A profile's values under explicit settings; None leaves the profile's value."""
        if profile not in PROFILES:
            raise ValueError(f"unknown training profile {profile!r}")
        return cls(**PROFILES[profile] | {k: v for k, v in settings.items() if v is not None})


#: Settings that differ from the defaults, by profile and purpose.
PROFILES = {"full": {}, "balanced": {"rounds": 2500, "patience": 200}, "balanced_walkforward": {"rounds": 1800, "patience": 200}}
#: Rounds between two writings of the margins.
TREES = 50


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(df)


def depth_of(num_leaves: int) -> int:
    """Depth of a level-wise tree that has room for so many leaves."""
    return max(1, (num_leaves - 1).bit_length())


def fit_gbt(train: DataFrame, valid: DataFrame, params: Params, seed: int) -> Model:
    """Spark's own ensemble with a fixed number of rounds; equal data and seed give equal first trees
    whatever the rounds, so ``fit_and_scan`` can ask for more only while the error still falls."""
    gbt = GBTRegressor(
        labelCol="target", featuresCol="features", seed=seed, maxIter=params.rounds, stepSize=params.learning_rate, maxDepth=depth_of(params.num_leaves),
        featureSubsetStrategy=str(params.feature_fraction), subsamplingRate=params.bagging_fraction, minInstancesPerNode=params.min_leaf, checkpointInterval=-1,
    )
    return gbt.fit(assemble(train, params.features))


def _share(*parts: object) -> float:
    """A number in [0, 1) by hash."""
    return int(hashlib.sha256(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 16**13


def tree_features(features: list[str], fraction: float, seed: int) -> list[int]:
    """Numbers of the features a tree may use, chosen by a seeded hash; at least one."""
    n = max(1, round(fraction * len(features)))
    return sorted(sorted(range(len(features)), key=lambda k: (_share(seed, features[k]), k))[:n])


def fit_boosted(train: DataFrame, valid: DataFrame | None, params: Params, seed: int) -> Ensemble:
    """Default ``fit_fn``: boosting that goes on tree by tree and stops when patience runs out.

    Rows carry their margin, the sum of the trees so far, as a column. Each round fits one
    Spark ML tree to the squared loss's negative gradient, adds it with the learning rate's
    weight (the first tree fits the target itself), and asks for the validation error in one
    pass, so no more trees are fitted than rounds are used. Features and rows of a round
    are shares chosen by seeded hashes. Every TREES rounds the margins are written and the table before goes,
    so that plans stay short and disk holds one copy. With full shares the trees are those of Spark's own ensemble.
    """
    spark, features = train.sparkSession, params.features
    model = Ensemble(errors=None if valid is None else [])
    bag = F.xxhash64(*features, "target")
    tables = {"train": train.select(*features, "target", bag.alias("__bag"), F.lit(0.0).alias("__margin"))}
    if valid is not None:
        tables["valid"] = valid.select(*features, "target", F.lit(0.0).alias("__margin"))
    paths: dict[str, str] = {}
    since = Ensemble()

    def write(name: str) -> None:
        rows = tables[name]
        if since.trees:
            rest = [c for c in rows.columns if c != "__margin"]
            rows = staged_at(rows, since, features, [len(since.trees)], rest, "__margin").select(*rest, F.get("sums", F.lit(0)).alias("__margin"))
        before = paths.get(name)
        paths[name] = scratch_path(spark, f"boosting-{name}")
        tables[name] = materialize_at(rows, paths[name])
        if before:
            remove(spark, before)

    for name in tables:
        write(name)
    try:
        for m in range(params.rounds):
            used = tree_features(features, params.feature_fraction, seed + m)
            rows = tables["train"] if params.bagging_fraction >= 1 else tables["train"].where(F.pmod(F.xxhash64("__bag", F.lit(seed + m)), F.lit(1 << 20)) < int(params.bagging_fraction * (1 << 20)))
            if since.trees:
                rows = staged_at(rows, since, features, [len(since.trees)], [*features, "target"], "__margin").withColumn("__margin", F.get("sums", F.lit(0)))
            y = F.col("target").cast("double")
            label = y if m == 0 else 2 * (y - F.col("__margin"))
            tree = DecisionTreeRegressor(labelCol="__label", featuresCol="features", seed=seed + m, maxDepth=depth_of(params.num_leaves), minInstancesPerNode=params.min_leaf)
            found = flatten(tree.fit(assemble(rows.select(*features, label.alias("__label")), [features[k] for k in used])), used)
            for part in (model, since):
                part.trees.append(found)
                part.treeWeights.append(1.0 if m == 0 else params.learning_rate)
            if valid is not None:
                model.errors.append((m + 1, staged_errors(tables["valid"], since, features, start="__margin").where(F.col("iter") == len(since.trees)).first()["rmse"]))
                if stopping_round(model.errors, params.patience)[1]:
                    break
            if len(since.trees) >= TREES and m + 1 < params.rounds:
                for name in tables:
                    write(name)
                since = Ensemble()
        return model
    finally:
        for path in paths.values():
            remove(spark, path)


def staged_predictions(model, df: DataFrame, features: list[str], point: int) -> DataFrame:
    """The rows with ``pred_<point>``, the sum of the first ``point`` trees."""
    whole = as_ensemble(model)
    if not 0 < point <= len(whole.trees):
        raise ValueError(f"the model has no {point} trees")
    return predict(df, whole.first(point), features, f"pred_{point}")


def staged_long(model, df: DataFrame, features: list[str], keep: list[str], points: list[int]) -> DataFrame:
    """One row per row and point: ``keep``, iter and prediction."""
    rows = staged_at(df, as_ensemble(model), features, points, keep)
    numbers = F.array(*map(F.lit, points))
    return rows.select(*keep, F.posexplode("sums").alias("__k", "prediction")).withColumn("iter", F.get(numbers, F.col("__k")).cast("int")).drop("__k")


def stopping_round(curve: list[tuple[int, float]], patience: int) -> tuple[int, bool]:
    """The round after ``patience`` rounds without a better error, or else the last;
    and whether patience has run out."""
    best, at = float("inf"), 0
    for i, value in sorted(curve):
        if value < best:
            best, at = value, i
        elif i - at >= patience:
            return i, True
    return max(i for i, _ in curve), False


def corr_curve(long: DataFrame, era: str = "era_int") -> DataFrame:
    return era_corr(long, ["iter", era]).groupBy("iter").agg(F.avg("corr").alias("corr"))


def best_corr_iteration(curve: DataFrame) -> DataFrame:
    """(iter, corr) of the largest correlation, the first among equals; NaN never wins,
    and if all are NaN the first point with minus infinity."""
    c = F.nullif(F.col("corr"), F.lit(float("nan")))
    row = curve.agg(F.max_by("iter", F.when(c.isNotNull(), F.struct(c.alias("c"), -F.col("iter")))).alias("i"), F.max(c).alias("c"), F.min("iter").alias("first"))
    return row.select(F.coalesce("i", "first").alias("iter"), F.coalesce("c", F.lit(float("-inf"))).alias("corr"))


def fit_and_scan(train: DataFrame, valid: DataFrame, params: Params, seed: int, fit_fn: FitFn = fit_boosted, era: str = "era_int") -> tuple[Model, dict]:
    """Fit until patience runs out on the validation error, and choose the iteration by ``select_best_by``.

    A fit that has watched its own errors has stopped by itself. For others rounds double from
    twice the patience (one scan period at least) until patience runs out or ``rounds`` are
    reached, and the errors of all rounds are one pass over the validation rows.
    """
    keep = [era, "target"]
    rows = valid.select(*keep, *params.features)
    rounds = params.rounds if fit_fn is fit_boosted else min(params.rounds, max(2 * params.patience, params.scan_period))
    while True:
        fitted = fit_fn(train, valid, replace(params, rounds=rounds), seed)
        model = as_ensemble(fitted)
        errors = model.errors or [(r["iter"], r["rmse"]) for r in staged_errors(rows, model, params.features).collect()]  # one row per round
        stop, over = stopping_round(errors, params.patience)
        if over or rounds >= params.rounds or len(model.trees) < rounds:
            break
        rounds = min(2 * rounds, params.rounds)
    best_rmse = min((r, i) for i, r in errors if i <= stop)
    points = sorted({*range(params.scan_period, stop + 1, params.scan_period), stop})
    found = best_corr_iteration(corr_curve(staged_long(model, rows, params.features, keep, points), era)).first()
    best = found["iter"] if params.select_best_by == "corr" else best_rmse[1]
    return fitted, {"best_iter": best, "best_corr": found["corr"], "best_rmse": best_rmse[0], "rounds": stop, "seed": seed}


def fit_final(rows: DataFrame, params: Params, rounds: int, seed: int) -> Model:
    """Fit on all rows with a fixed number of rounds."""
    return fit_boosted(rows, None, replace(params, rounds=rounds), seed)


def walk_forward(rows: DataFrame, windows: DataFrame, params: Params, seed: int, fit_fn: FitFn = fit_boosted, era: str = "era_int", done: DataFrame | None = None, at_once: int = 1) -> tuple[DataFrame, DataFrame]:
    """Window rows and their summary. Windows are a few configured rows and drive the
    loop; each fit is a distributed job, ``at_once`` of them side by side; windows in ``done`` are not fitted again."""
    spark = rows.sparkSession
    todo = windows if done is None else pending(windows, done, ["window_id"])

    def one(w) -> tuple | None:
        train, valid = train_rows(rows, w["train_end"], era), rows.where(F.col(era).between(w["val_start"], w["val_end"]))
        if train.isEmpty() or valid.isEmpty():
            return None
        _, found = fit_and_scan(train, valid, params, seed, fit_fn, era)
        return w["window_id"], int(found["best_iter"]), float(found["best_corr"]), float(found["best_rmse"])

    fits = side_by_side(spark, [partial(one, w) for w in todo.orderBy("window_id").collect()], at_once)
    out = [f for f in fits if f is not None]
    if not out and (done is None or done.isEmpty()):
        raise ValueError("no usable walk-forward window")
    report = spark.createDataFrame(out, "window_id int, best_iter int, corr double, rmse double")
    if done is not None:
        report = report.unionByName(done.select(*report.columns))
    return report, summarize(report)


def collect_oof(rows: DataFrame, windows: DataFrame, params: Params, seed: int, fit_fn: FitFn = fit_boosted, era: str = "era_int", min_rows: int = 512, min_eras: int = 8) -> DataFrame:
    """Out-of-fold predictions (window_id with the rows' columns and ``prediction``) at
    each window's best iteration, clamped to the trees that were fitted; validation is
    limited to covered rows. Windows without training rows, or with fewer covered rows or
    eras than asked for, are skipped before anything is fitted."""
    out = None
    for w in windows.orderBy("window_id").collect():
        train = train_rows(rows, w["train_end"], era)
        valid = rows.where(F.col(era).between(w["val_start"], w["val_end"]) & F.col("bench_present"))
        covered = valid.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(era).alias("eras")).first()
        if covered["n"] < max(min_rows, 1) or covered["eras"] < min_eras or train.isEmpty():
            continue
        model, found = fit_and_scan(train, valid, params, seed, fit_fn, era)
        best = min(found["best_iter"], len(as_ensemble(model).trees))
        part = staged_predictions(model, valid, params.features, best)
        part = part.select(F.lit(w["window_id"]).alias("window_id"), *(c for c in valid.columns if c not in params.features), F.col(f"pred_{best}").cast("float").alias("prediction"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no window has enough covered rows")
    return out


def train_ensemble(train: DataFrame, valid: DataFrame, params: Params, seeds: list[int], done: DataFrame | None = None, fit_fn: FitFn = fit_boosted, at_once: int = 1) -> tuple[dict[int, Model], list[dict]]:
    """One member per seed that has no finished result yet, ``at_once`` fitted side by side."""
    finished = set() if done is None else {r["seed"] for r in done.select("seed").distinct().collect()}
    todo = [s for s in dict.fromkeys(seeds) if s not in finished]
    fits = side_by_side(train.sparkSession, [partial(fit_and_scan, train, valid, params, s, fit_fn) for s in todo], at_once)
    models, members = {s: model for s, (model, _) in zip(todo, fits, strict=True)}, [found for _, found in fits]
    if {*finished, *models} < set(seeds):
        raise ValueError("some seeds did not finish")
    return models, members


def score_ensemble(df: DataFrame, models: dict[str, tuple[Model, list[str]]], out: str = "prediction") -> DataFrame:
    """Each model's prediction from its own features, then their mean as float."""
    rows, columns = df, []
    for k, (model, features) in enumerate(models.values()):
        rows = predict(rows, as_ensemble(model), features, f"__p{k}")
        columns.append(f"__p{k}")
    mean = reduce(lambda a, b: a + b, map(F.col, columns)) / len(columns)
    return rows.select(*df.columns, mean.cast("float").alias(out))


def features_of_models(models: DataFrame, mapping: DataFrame, union: list[str]) -> DataFrame:
    """(model_file, features): a model's own list in order, the union where it has none."""
    own = mapping.groupBy("model_file").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "feature"))), lambda x: x["feature"]).alias("own"))
    return models.join(own, "model_file", "left").select("model_file", F.coalesce("own", F.array(*map(F.lit, union))).alias("features"))
