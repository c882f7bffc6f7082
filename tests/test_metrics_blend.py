from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from eraloom.functions import ranks
from eraloom.operators import blend, metrics, neutralize, walkforward
from eraloom.operators.neutralize import PostprocessConfig


def gauss(x):
    x = np.asarray(x, float)
    rank = np.array([(np.sum(x < v) + 1 + np.sum(x <= v)) / 2 for v in x])
    return np.array([NormalDist().inv_cdf((r - 0.5) / len(x)) for r in rank])


def corr(p, t):
    g, t = gauss(p), np.asarray(t, float) - np.mean(t)
    a, b = np.sign(g) * abs(g) ** 1.5, np.sign(t) * abs(t) ** 1.5
    d = a.std() * b.std()
    return float(((a - a.mean()) * (b - b.mean())).mean() / d) if d else 0.0


def neutral(y, x, prop):
    d = np.column_stack([np.ones(len(y)), x])
    r = y - prop * (d @ np.linalg.lstsq(d, y, rcond=None)[0])
    return r if r.std() < 1e-12 else r / r.std()


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(5)
    return [(str(k), int(k // 50) + 1, float(rng.normal()), float(rng.integers(0, 5) / 4), float(rng.normal()), float(rng.normal()), 1) for k in range(200)]


@pytest.fixture()
def frame(spark, table):
    return spark.createDataFrame(table, "id string, era_int int, prediction double, target double, b1 double, b2 double, window_id int")


def _by_era(table, f):
    return [f([r for r in table if r[1] == e]) for e in sorted({r[1] for r in table})]


def test_corr_per_era_and_monotone_invariance(frame, table):
    expected = _by_era(table, lambda p: corr([r[2] for r in p], [r[3] for r in p]))
    got = [r["corr"] for r in metrics.era_corr(frame, ["era_int"]).orderBy("era_int").collect()]
    assert np.allclose(got, expected)
    twisted = frame.withColumn("prediction", F.exp("prediction")).repartition(5)
    assert np.allclose([r["corr"] for r in metrics.era_corr(twisted, ["era_int"]).orderBy("era_int").collect()], expected)
    assert np.isclose(metrics.mean_corr(frame).first()["mean_corr"], np.mean(expected))


def test_single_row_and_constant_eras_have_zero_corr(spark):
    df = spark.createDataFrame([(1, 0.3, 1.0), (2, 0.1, 0.5), (2, 0.2, 0.5)], "era_int int, prediction double, target double")
    assert [r["corr"] for r in metrics.era_corr(df, ["era_int"]).collect()] == [0.0, 0.0]


def _ranked(table, col):
    return np.concatenate(_by_era(table, lambda p: gauss([r[col] for r in p])))


def test_bmc_neutralizes_over_all_eras(frame, table):
    g, x = _ranked(table, 2), np.column_stack([_ranked(table, 4), _ranked(table, 5)])
    resid = neutral(g, x, 1.0)
    t = np.concatenate(_by_era(table, lambda p: np.array([r[3] for r in p]) - np.mean([r[3] for r in p])))
    eras = np.array([r[1] for r in table])
    expected = np.mean([np.mean((resid * t)[eras == e]) for e in np.unique(eras)])
    assert np.isclose(metrics.bmc(frame, ["b1", "b2"]).first()["bmc"], expected)


@pytest.mark.parametrize("prop", [0.0, 0.5, 1.0])
def test_neutralize_against_lstsq(frame, table, prop):
    y, x = np.array([r[2] for r in table]), np.array([[r[4], r[5]] for r in table])
    got = {r["id"]: r["n"] for r in neutralize.neutralize(frame, "prediction", ["b1", "b2"], prop, "n").collect()}
    assert np.allclose([got[r[0]] for r in table], neutral(y, x, prop))


def test_rank_deficient_design(frame, table):
    twice = frame.withColumn("b3", F.col("b1") * 2)
    got = {r["id"]: r["n"] for r in neutralize.neutralize(twice, "prediction", ["b1", "b3"], 1.0, "n").collect()}
    assert np.allclose([got[r[0]] for r in table], neutral(np.array([r[2] for r in table]), np.array([[r[4]] for r in table]), 1.0))


def chain(table, alpha, prop, transform="rank_01", columns=(4, 5)):
    """The post-process chain row by row."""
    g, x = _ranked(table, 2), np.column_stack([_ranked(table, c) for c in columns])
    mixed = (alpha * g + (1 - alpha) * neutral(g, x, prop)).astype(np.float32)
    eras = np.array([r[1] for r in table])
    out = np.empty(len(table))
    for e in np.unique(eras):
        q = gauss(mixed[eras == e])
        out[eras == e] = q if transform == "gauss_rank" else [NormalDist().cdf(v) for v in q]
    return out


@pytest.mark.parametrize(("alpha", "prop", "transform", "by_range"), [(0.4, 0.5, "rank_01", False), (0.4, 0.5, "gauss_rank", True), (0.0, 1.0, "gauss_rank", False), (1.0, 0.3, "rank_01", False)])
def test_postprocess_row_by_row(frame, table, alpha, prop, transform, by_range):
    out = neutralize.postprocess(frame, PostprocessConfig(alpha, prop, ("b1", "b2"), transform), by_range=by_range)
    got = {r["id"]: r["submission"] for r in out.collect()}
    assert np.allclose([got[r[0]] for r in table], chain(table, alpha, prop, transform))
    if alpha < 1:  # a wrong setting shows
        assert not np.allclose([got[r[0]] for r in table], chain(table, 1.0, prop, transform))


def test_metrics_by_range_equal_plain_ones(spark, frame):
    """One era with most rows: the range form of every metric gives what the plain form gives."""
    hot = frame.withColumn("era_int", F.when(F.col("era_int") < 4, 1).otherwise(2)).withColumn("prediction", F.round("prediction", 1))
    same = lambda f: np.allclose(*(sorted(map(tuple, f(r).collect())) for r in (False, True)))
    assert same(lambda r: metrics.era_corr(hot, ["era_int"], by_range=r))
    assert same(lambda r: metrics.mean_corr(hot, by_range=r))
    assert same(lambda r: metrics.bmc(hot, ["b1", "b2"], by_range=r))
    assert same(lambda r: neutralize.blend(hot, "prediction", ["b1", "b2"], 0.4, 0.5, by_range=r).select(F.col("id").cast("int"), "blended"))
    assert same(lambda r: blend.score_grid(hot, ["b1", "b2"], blend.grid(spark, [0.3, 1.0], [0.5]), by_range=r).select("grid_pos", "window_id", "corr", "bmc", "score"))


def test_per_era_feature_neutralization_is_orthogonal(frame):
    out = neutralize.neutralize_per_era(frame, "prediction", ["b1"], 1.0)
    assert all(abs(r[1]) < 1e-9 for r in out.groupBy("era_int").agg(F.covar_pop("neutral", "b1")).collect())


@pytest.mark.parametrize(("block", "fan"), [(4096, 64), (7, 2)])
def test_per_era_fit_of_many_features_over_many_tasks(spark, monkeypatch, block, fan):
    """64 features, one era in every task, one era of fewer rows than features, dependent features, a null era and missing values."""
    monkeypatch.setattr(neutralize, "BLOCK", block)
    monkeypatch.setattr(neutralize, "FAN", fan)
    rng = np.random.default_rng(11)
    names = [f"f{k}" for k in range(64)]
    rows = []
    for k in range(900):
        era = 1 if k % 3 else 2 if k % 2 else None
        x = rng.normal(size=64).round(3).tolist()
        x[1] = x[0] * 2  # dependent
        rows.append((k, era, float(rng.normal()) + x[5], *x))
    rows += [(1000 + k, 3, float(rng.normal()), *rng.normal(size=64).tolist()) for k in range(20)] + [(2000, 1, None, *[0.0] * 64), (2001, 1, 1.0, *[float("nan")] * 64), (2002, 4, 5.0, *[1.0] * 64)]
    df = spark.createDataFrame(rows, "id int, era_int int, y double, " + ", ".join(f"{n} double" for n in names)).repartition(11)
    got = {r["id"]: r["neutral"] for r in neutralize.neutralize_per_era(df, "y", names, 0.7).collect()}
    assert len(got) == len(rows) and got[2000] is None and got[2001] is None
    for era in (1, 2, None, 3, 4):
        own = [r for r in rows if r[1] == era and r[0] not in (2000, 2001)]
        expected = neutral(np.array([r[2] for r in own]), np.array([r[3:] for r in own]), 0.7)
        assert np.allclose([got[r[0]] for r in own], expected, atol=1e-7), era


def test_per_era_fit_of_text_eras(frame):
    named = frame.withColumn("era", F.concat(F.lit("era"), "era_int"))
    rows = lambda d: sorted((r["id"], round(r["neutral"], 9)) for r in d.collect())
    assert rows(neutralize.neutralize_per_era(named, "prediction", ["b1", "b2"], 0.5, "era")) == rows(neutralize.neutralize_per_era(frame, "prediction", ["b1", "b2"], 0.5))
    assert neutralize.neutralize_per_era(frame.limit(0), "prediction", ["b1"]).count() == 0


def test_config_checks():
    with pytest.raises(ValueError, match="transform"):
        PostprocessConfig(0.5, 0.5, ("b",), "other")
    with pytest.raises(ValueError, match="blend_alpha"):
        PostprocessConfig(1.5, 0.5, ("b",))
    with pytest.raises(ValueError, match="empty"):
        PostprocessConfig(0.5, 0.5, ())
    assert PostprocessConfig.from_json('{"blend_alpha": 0.5, "bench_neutralize_prop": 0.5, "bench_cols_used": ["b"]}').submission_transform == "rank_01"


def test_grid_agrees_with_single_runs(spark, frame):
    scores = blend.score_grid(frame, ["b1", "b2"], blend.grid(spark, [0.3], [0.5]))
    row = scores.first()
    one = neutralize.blend(frame, "prediction", ["b1", "b2"], 0.3, 0.5)
    assert np.isclose(row["corr"], metrics.mean_corr(one.drop("prediction").withColumnRenamed("blended", "prediction")).first()["mean_corr"])
    assert np.isclose(row["bmc"], metrics.bmc(frame, ["b1", "b2"], proportion=0.5).first()["bmc"])
    best = blend.best_point(blend.summarize_grid(blend.score_grid(frame, ["b1"], blend.grid(spark, [1.0, 1.0], [0.5])))).first()
    assert best["grid_pos"] == 0


def test_windows_of_624_eras(spark):
    got = [tuple(r) for r in walkforward.build_windows(spark.range(1, 625).selectExpr("int(id) AS era_int")).orderBy("window_id").collect()]
    assert [(w[0], w[2], w[3], w[4], w[5], w[6]) for w in got] == [(1, 148, 149, 156, 157, 312), (2, 304, 305, 312, 313, 468), (3, 460, 461, 468, 469, 624)]


def test_rank_01_inside_groups(frame):
    lo, hi = frame.select(ranks.rank_01("prediction", ["era_int"]).alias("u")).agg(F.min("u"), F.max("u")).first()
    assert (lo, hi) == (0.01, 0.99)
