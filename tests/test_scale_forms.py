"""Forms of operators for tables that outgrow a task or a driver loop: equal to the plain forms."""

from __future__ import annotations

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from eraloom.functions import ranks
from eraloom.operators import align, blend, gates, modelling, resume, walkforward
from eraloom.operators.errors import AlignmentError
from eraloom.plans import scratch
from eraloom.plans.queries import KnownTree
from eraloom.sources import published, splits


@pytest.mark.parametrize(("ordered", "digits"), [(10_000, 4), (3, 1), (0, 2)])
def test_sample_is_the_head_of_the_hash_order(spark, monkeypatch, ordered, digits):
    monkeypatch.setattr(gates, "ORDERED", ordered)
    monkeypatch.setattr(gates, "DIGITS", digits)
    df = spark.range(700).select((F.col("id") % 650).cast("string").alias("id"), F.col("id").alias("v")).repartition(5)  # fifty ids twice
    key = F.sha2(F.concat_ws(":", F.lit(3), F.col("id")), 256)
    for n in (0, 1, 5, 64, 699, 700, 900):
        got = gates.sample_rows(df, n, 3).collect()
        want = [r["id"] for r in df.orderBy(key, "id").limit(n).select("id").collect()]
        assert len(got) == min(n, 700) and sorted(r["id"] for r in got) == sorted(want), n
        assert len({r["v"] for r in got}) == len(got)
    assert gates.sample_rows(df.limit(0), 5).count() == 0


def test_fits_run_side_by_side(spark):
    """Two fits wait for each other, so they must overlap; results come in order and equal the serial ones."""
    meeting, pools = threading.Barrier(2, timeout=120), set()

    def fit(train, valid, params, seed):
        if seed >= 100:
            meeting.wait()
            pools.add(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        return modelling.Ensemble([KnownTree({0: 1.0 / (seed % 100)})], [1.0])

    rows = spark.range(200).select((F.col("id") % 12 + 1).cast("int").alias("era_int"), (F.col("id") % 7 / 7.0).alias("target"), (F.col("id") % 5 / 1.0).alias("feature_0"))
    params = modelling.Params(rounds=1, patience=1, scan_period=1, features=["feature_0"])
    _, serial = modelling.train_ensemble(rows, rows, params, [1, 2], fit_fn=fit)
    models, both = modelling.train_ensemble(rows, rows, params, [101, 102], fit_fn=fit, at_once=2)
    assert list(models) == [101, 102] and [{**m, "seed": m["seed"] % 100} for m in both] == serial and len(pools) == 2
    windows = walkforward.build_windows(rows, 3, 0)
    again = lambda seed, at_once: sorted(map(tuple, modelling.walk_forward(rows, windows.where("window_id <= 2"), params, seed, fit, at_once=at_once)[0].collect()))
    assert again(101, 2) == again(1, 1)


def test_the_cleanup_switch_survives_two_writers(spark):
    spark.conf.set(scratch._CLEANUP, "false")
    inside = threading.Barrier(2, timeout=60)

    def write():
        with scratch._cleaning(spark):
            inside.wait()
            return spark.conf.get(scratch._CLEANUP)

    assert scratch.side_by_side(spark, [write, write], 2) == ["true", "true"]
    assert spark.conf.get(scratch._CLEANUP) == "false"

    def bad():
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        scratch.side_by_side(spark, [bad, bad], 2)


def tables(spark, n_valid_missing=0, repeat=False):
    ids = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("id"))
    bench = lambda a, b, step=1: spark.range(a, b, step).select("id", (F.col("id") * 0.5).alias("b1"), F.when(F.col("id") % 4 != 0, 1.0).alias("b2"))
    valid = bench(100 + n_valid_missing, 150)
    return ids(0, 100), ids(100, 150), bench(0, 100, 3), valid.union(valid.limit(1)) if repeat else valid


def test_three_splits_from_one_profile(spark):
    train, valid, bt, bv = tables(spark)
    got = {r["split"]: r for r in align.profile_splits(train, valid, bt, bv).collect()}
    assert {k: (r["n_rows"], r["n_covered"], r["n_missing"], r["n_repeated"]) for k, r in got.items()} == {"train": (100, 34, 66, 0), "validation": (50, 50, 0, 0), "all": (150, 84, 66, 0)}
    assert got["train"]["null_ratio_b2"] == 9 / 34 and got["validation"]["null_ratio_b2"] == 13 / 50 and got["all"]["null_ratio_b1"] == 0
    found = align.align_splits(train, valid, bt, bv)
    assert {k: (a.columns, a.dropped) for k, a in found.items()} == {k: (["b1"], ["b2"]) for k in ("train", "validation", "all")}
    for name, main, bench, partial in (("train", train, bt, True), ("validation", valid, bv, False), ("all", train.union(valid), bt.union(bv), True)):
        one = align.align_benchmarks(main, bench, allow_partial=partial)
        assert one.columns == found[name].columns
        assert sorted(map(tuple, one.rows.select("id", "b1", "bench_present").collect())) == sorted(map(tuple, found[name].rows.select("id", "b1", "bench_present").collect()))


def test_splits_that_do_not_agree(spark):
    train, valid, bt, bv = tables(spark)
    with pytest.raises(AlignmentError, match="missing_count=5"):
        align.align_splits(*tables(spark, n_valid_missing=5))
    with pytest.raises(AlignmentError, match="repeat"):
        align.align_splits(*tables(spark, repeat=True))
    with pytest.raises(AlignmentError, match="too many columns"):
        align.align_splits(train, valid, bt, bv, min_columns=2)
    with pytest.raises(AlignmentError, match="nulls remain"):
        align.align_splits(train, valid, bt, bv, max_null_ratio=0.5)
    with pytest.raises(AlignmentError, match="different columns"):
        align.align_splits(train, valid, bt.where("id % 4 != 0"), bv)
    with pytest.raises(AlignmentError, match="schema"):
        align.align_splits(train, valid, bt, bv.drop("b2"))
    with pytest.raises(AlignmentError, match="repeat in all"):
        align.align_splits(train, valid, bt.union(bv.limit(1)), bv)
    with pytest.raises(AlignmentError, match="covered|empty"):
        align.align_splits(train, valid, bt.limit(0), bv)


def test_expanding_fits_against_lstsq(spark):
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(1, 41)), *map(float, rng.normal(size=3))) for _ in range(800)] + [(3, None, 1.0, 1.0), (3, 1.0, float("nan"), 1.0), (None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "era_int int, y double, a double, b double").repartition(4)
    windows = walkforward.build_windows(df, 8, 2)
    got = {r["window_id"]: r for r in walkforward.expanding_fits(df, windows, "y", ["a", "b"]).collect()}
    for w in windows.collect():
        own = np.array([r[1:] for r in rows[:800] if w["train_start"] <= r[0] <= w["train_end"]])
        beta = np.linalg.lstsq(np.column_stack([np.ones(len(own)), own[:, 1:]]), own[:, 0], rcond=None)[0]
        r = got[w["window_id"]]
        assert r["n"] == len(own) and np.allclose([r["intercept"], *r["beta"]], beta)
    assert len(got) == windows.count() > 2


def test_member_features(spark):
    mapping = spark.createDataFrame([("m", 1, "b"), ("m", 0, "a"), ("n", 0, "c"), ("n", 1, "a")], "features_key string, pos int, feature string")
    lists = {r["features_key"]: (r["features"], r["features_hash"]) for r in resume.feature_lists(mapping).collect()}
    import hashlib

    assert lists["m"] == (["a", "b"], hashlib.sha256(b"a\nb").hexdigest()[:16])
    assert [tuple(r) for r in resume.feature_union(mapping).orderBy("pos").collect()] == [(0, "a"), (1, "b"), (2, "c")]
    members = [(1, "m", 5, "", lists["m"][1], 2), (2, "m", 5, "n", lists["m"][1], 0), (3, "n", 5, "", "", 3), (4, "gone", 5, "", "", 0), (5, "gone", 5, "n", "", 2)]
    df = spark.createDataFrame(members, "seed int, model_file string, best_iteration int, features_key string, features_hash string, n_features_used int")
    got = {r["seed"]: r["problem"] for r in resume.check_member_features(resume.normalize_members(df), mapping).collect()}
    assert got == {1: None, 2: "hash", 3: "count", 4: "no_features", 5: None}


def test_published_versions(spark, tmp_path):
    """A failed write leaves the version before; a history is rewritten from itself; old versions go."""
    path = str(tmp_path / "table")
    rows = lambda v: spark.range(3).select((F.col("id") + v).alias("x"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        published.current(spark, path)
    published.publish(rows(0), path)
    with pytest.raises(Exception):  # noqa: B017
        published.publish(rows(5).select(F.raise_error(F.lit("broken")).alias("x")), path)
    seen = lambda: sorted(r["x"] for r in spark.read.parquet(published.current(spark, path)).collect())
    assert seen() == [0, 1, 2] and len(published.versions(spark, path)) == 1
    for k in range(4):
        published.publish(spark.read.parquet(published.current(spark, path)).select((F.col("x") + 1).alias("x")), path)
        assert seen() == [k + 1, k + 2, k + 3]
    assert [n for n, _ in published.versions(spark, path)] == [3, 4]


def test_a_scope_leaves_only_what_is_kept(spark):
    import os

    with scratch.scratch_scope(spark) as outer:
        with scratch.scratch_scope(spark) as keep:
            one = scratch.materialize(spark.range(5), "one")
            two = keep(scratch.materialize(one.where("id > 1"), "two"))
            side = scratch.side_by_side(spark, [lambda k=k: scratch.materialize(spark.range(k), "side") for k in (1, 2)], 2)
        assert not os.path.exists(one.scratch_path) and two.count() == 3 and not any(os.path.exists(s.scratch_path) for s in side)
        three = outer(scratch.materialize(two, "three"))
    assert not os.path.exists(two.scratch_path) and three.count() == 3


def test_prepared_copies_of_old_files_go(spark, tmp_path):
    import glob

    path, root = str(tmp_path / "t"), spark.conf.get("spark.checkpoint.dir")
    make = lambda: spark.range(4).selectExpr("id AS feature_0", "'era1' AS era", "string(id) AS id", "1D AS target").write.mode("append").parquet(path)
    make()
    before = set(glob.glob(f"{root}/prepared-*/*"))
    assert splits.prepared_split(spark, path, ["feature_0"]).count() == 4
    make()
    spark.catalog.refreshByPath(path)
    assert splits.prepared_split(spark, path, ["feature_0"]).count() == 8
    assert len(set(glob.glob(f"{root}/prepared-*/*")) - before) == 1


def test_the_grid_by_range_numbers_rows_once(spark, monkeypatch):
    """Rows times points are dealt from the written rows, and equal the plain form."""
    written = []

    def record(df, name):
        written.append(name)
        return scratch.materialize(df, name)

    monkeypatch.setattr(ranks, "materialize", record)
    rows = spark.range(600).selectExpr("int(id % 2) as window_id", "int(id % 4) as era_int", "(id * 37) % 101 / 7.0 as prediction", "(id % 5) / 4.0 as target", "double((id * 53) % 97) as b1", "double((id * 29) % 11) as b2")
    points = blend.grid(spark, [0.0, 0.5, 1.0], [0.25, 1.0])
    score = lambda by_range: sorted(map(tuple, blend.score_grid(rows, ["b1", "b2"], points, by_range=by_range).select("alpha", "prop", "window_id", "corr", "bmc", "score", "hit").collect()))
    plain = score(False)
    written.clear()
    ranged = score(True)
    assert written.count("range-rows") == 1 and written.count("group-means") == 1
    assert len(plain) == len(ranged) == 12
    for a, b in zip(plain, ranged):
        assert a[:3] == b[:3] and a[6] == b[6]
        assert np.allclose(a[3:6], b[3:6], atol=1e-12)
