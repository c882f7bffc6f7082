from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eraloom.operators import align, gates
from eraloom.operators.errors import AlignmentError, DriftGuardError


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def test_id_types_differ(spark):
    main = spark.createDataFrame([(1,), (2,)], "id long")
    bench = spark.createDataFrame([("1", 0.1), ("2", 0.2)], "id string, b double")
    got = align.align_benchmarks(main, bench)
    assert got.columns == ["b"] and got.rows.where("bench_present").count() == 2


def test_missing_and_duplicate_ids(spark):
    one = spark.createDataFrame([("a", 0.1)], "id string, b double")
    with pytest.raises(AlignmentError, match="missing_count=1.*b"):
        align.align_benchmarks(ids(spark, "a", "b"), one)
    with pytest.raises(AlignmentError, match="duplicate_count=1"):
        align.align_benchmarks(ids(spark, "a"), one.union(one))
    with pytest.raises(AlignmentError, match="no row is covered"):
        align.align_benchmarks(ids(spark, "z"), one, allow_partial=True)


def test_sparse_columns(spark):
    main = ids(spark, "a", "b", "c")
    bench = spark.createDataFrame([("a", 0.1, 0.4), ("b", 0.2, None), ("c", 0.3, 0.6)], "id string, dense double, sparse double")
    assert align.align_benchmarks(main, bench).columns == ["dense"]
    with pytest.raises(AlignmentError, match="nulls remain"):
        align.align_benchmarks(main, bench, drop_sparse=False)
    with pytest.raises(AlignmentError, match="removed too many columns"):
        align.align_benchmarks(main, bench, min_columns=2)


def test_partial_coverage_is_zero_filled(spark):
    bench = spark.createDataFrame([("c", 0.3), ("a", 0.1)], "id string, b double")
    rows = align.align_benchmarks(ids(spark, "a", "b", "c"), bench, allow_partial=True).rows.orderBy("id").collect()
    assert [(r["bench_present"], round(r["b"], 6)) for r in rows] == [(True, 0.1), (False, 0.0), (True, 0.3)]


def test_live_alignment(spark):
    live = ids(spark, "b", "a")
    bench = spark.createDataFrame([("a", 0.1, "X"), ("b", 0.2, "Y")], "id string, b1 double, era string")
    got = align.align_live(live, bench, ["b1", "era"])
    assert got.columns == ["b1"] and got.dropped == ["era"]
    with pytest.raises(DriftGuardError, match="numeric"):
        align.align_live(live, bench, ["era"])
    with pytest.raises(DriftGuardError, match="missing"):
        align.align_live(live, bench, ["b9"])


@pytest.mark.parametrize(("preds", "gate"), [([0.0, 0.3, 0.7], "rank_bounds"), ([0.2, 0.3, 1.0], "rank_bounds"), ([1e-6, 0.3, 1 - 1e-6], None), ([0.5, 0.5, 0.5], "spread"), ([0.2, float("nan"), 0.4], "invalid_numbers")])
def test_gates(spark, preds, gate):
    df = spark.createDataFrame([(str(k), a, b, p) for k, (a, b, p) in enumerate(zip([1.0, 2.0, 3.0], [2.0, 1.0, 4.0], preds))], "id string, f1 double, f2 double, prediction float")
    report = gates.gate_report(df, ["f1", "f2"], gates.GateLimits(max_abs_exposure=1.0, sample_rows=2))
    if gate is None:
        gates.assert_gates(report)
    else:
        with pytest.raises(DriftGuardError, match=gate):
            gates.assert_gates(report)


def test_exposure_is_over_all_rows(spark):
    """More rows than the 200,000 that were once sampled."""
    df = spark.range(200_500).select(F.col("id").cast("string").alias("id"), (F.col("id") % 97).cast("double").alias("f"), ((F.col("id") * 7919 % 1009 + F.col("id") % 97 + 1) / 1200).alias("prediction"))
    report = {r["gate"]: r["value"] for r in gates.gate_report(df, ["f"], gates.GateLimits()).collect()}
    assert report["exposure"] == pytest.approx(df.agg(F.abs(F.corr("f", "prediction"))).first()[0], abs=1e-12)


def test_feature_shards(spark):
    catalog = spark.createDataFrame([(f"f{k}",) for k in range(50)], "feature string")
    one, two = (sorted(map(tuple, gates.feature_shards(catalog, [1, 2, 3], 12, 7).collect())) for _ in range(2))
    assert one == two and len(one) == 36
    first = {s: {f for t, f in one if t == s} for s in (1, 2, 3)}
    assert not first[1] & first[2]
    assert gates.feature_shards(catalog, [1], 0).count() == 50


def test_exposure_of_constant_feature_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0.1), (2.0, 5.0, 0.2)], "a double, b double, prediction double")
    got = {r["feature"]: r["exposure"] for r in gates.exposures(df, ["a", "b"]).collect()}
    assert got["b"] is None and abs(got["a"] - 1) < 1e-12
    assert gates.sample_rows(df.withColumn("id", F.col("a")), 1).count() == 1
