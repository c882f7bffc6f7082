from __future__ import annotations

import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from eraloom.functions import ranks, scalars


def test_norm_ppf_matches_the_standard_library(spark):
    points = [1e-12, 1e-6, 0.01, 0.074, 0.3, 0.5, 0.8, 0.925, 0.999, 1 - 1e-9]
    got = spark.createDataFrame([(p,) for p in points], "p double").select("p", scalars.norm_ppf(F.col("p")).alias("z")).collect()
    assert all(abs(r["z"] - NormalDist().inv_cdf(r["p"])) < 1e-9 for r in got)


def test_era_to_int(spark):
    df = spark.createDataFrame([("era1",), ("era20",), ("era003",), (None,)], "era string")
    assert [r[0] for r in df.select(scalars.era_to_int(F.col("era"))).collect()] == [1, 20, 3, None]
    bad = spark.createDataFrame([("none",)], "era string")
    assert bad.select(scalars.era_to_int(F.col("era"), strict=False)).first()[0] is None
    with pytest.raises(Exception, match="no era number"):
        bad.select(scalars.era_to_int(F.col("era"))).collect()


def test_pick_stops_at_a_present_null(spark):
    m = spark.sql("SELECT map('a', CAST(NULL AS STRING), 'b', 'x') AS m")
    row = m.select(scalars.pick(F.col("m"), ["A", "b"]).alias("p"), scalars.pick(F.col("m"), ["z", "B"]).alias("q")).first()
    assert (row["p"], row["q"]) == (None, "x")


def test_bool_and_scan_points(spark):
    df = spark.createDataFrame([("True",), ("y",), ("0",), ("2",), ("no",), (None,)], "x string")
    assert [r[0] for r in df.select(scalars.to_bool(F.col("x"))).collect()] == [True, True, False, True, False, False]
    pts = spark.createDataFrame([(250,), (200,), (50,)], "n int").select(scalars.scan_points(F.col("n"), 100)).collect()
    assert [r[0] for r in pts] == [[100, 200, 250], [100, 200], [50]]


def _average_rank(x):
    x = np.asarray(x)
    return [(np.sum(x < v) + 1 + np.sum(x <= v)) / 2 for v in x]


def test_average_rank_ties_nan_and_range_variant(spark):
    rng = np.random.default_rng(0)
    data = [(int(e), float(v), k) for k, (e, v) in enumerate(zip(rng.integers(0, 3, 200), rng.integers(0, 20, 200)))]
    df = spark.createDataFrame(data, "e int, v double, k int").repartition(7)
    expected = {}
    for e in range(3):
        part = [(k, v) for x, v, k in data if x == e]
        expected |= dict(zip([k for k, _ in part], _average_rank([v for _, v in part])))
    assert {r["k"]: r["r"] for r in df.select("k", ranks.average_rank("v", ["e"]).alias("r")).collect()} == expected
    assert {r["k"]: r["r"] for r in ranks.average_rank_by_range(df, "v", ["e"], "r").collect()} == expected
    bad = spark.createDataFrame([(1, 1.0), (1, float("nan")), (2, 5.0)], "e int, v double")
    got = {r["e"]: r["r"] for r in bad.select("e", ranks.average_rank("v", ["e"]).alias("r")).collect()}
    assert np.isnan(got[1]) and got[2] == 1.0


def test_ranks_by_range_equal_plain_ranks(spark):
    """Ties, nulls and NaN groups, whatever the ranges are."""
    import math
    import random

    from eraloom.functions import ranks

    rng = random.Random(3)
    rows = [(k, k % 3, None if k % 41 == 0 else float("nan") if k == 50 else float(rng.randint(0, 30))) for k in range(400)]
    df = spark.createDataFrame(rows, "id int, era_int int, x double").repartition(5)
    shape = lambda v: None if v is None else "nan" if math.isnan(v) else round(v, 9)
    seen = lambda d, c: {r["id"]: shape(r[c]) for r in d.collect()}
    assert seen(ranks.average_rank_by_range(df, "x", ["era_int"]), "avg_rank") == seen(df.withColumn("avg_rank", ranks.average_rank("x", ["era_int"])), "avg_rank")
    assert seen(ranks.gauss_ranks(df, ["x"], ["era_int"], by_range=True), "g_x") == seen(ranks.gauss_ranks(df, ["x"], ["era_int"]), "g_x")


def test_range_ranks_of_hot_groups_and_values(spark):
    """One group with most rows, one value with half of them, nulls and a NaN group, over several columns."""
    rng = random.Random(8)
    value = lambda: rng.choice([1.5, 1.5, 1.5, rng.random(), None, -0.5, 2.0])
    rows = [(k, "hot" if k % 5 else f"g{k % 3}", value(), float(rng.randint(0, 3)), 7.0) for k in range(3000)]
    rows += [(4000 + k, "nan", math.nan if k == 3 else float(k), 1.0, 7.0) for k in range(20)] + [(5000, None, 1.0, None, 7.0), (5001, None, 0.5, 2.0, 7.0)]
    df = spark.createDataFrame(rows, "id long, era string, a double, b double, c double").repartition(6)
    columns = ["a", "b", "c"]
    plain = df.select("id", *(ranks.rank_01(c, ["era"]).alias(f"__u_{c}") for c in columns))
    seen = lambda d: sorted((tuple(None if v is None or v != v else round(v, 12) for v in r) for r in d.collect()))
    spread = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert seen(ranks.shares_by_range(df, columns, ["era"]).select("id", *(f"__u_{c}" for c in columns))) == seen(plain)
        for c in columns:
            assert seen(ranks.average_rank_by_range(df, c, ["era"], "r", share=True).select("id", "r")) == seen(plain.select("id", f"__u_{c}"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", spread)


def test_centred_values_by_range(spark):
    df = spark.createDataFrame([(k, None if k % 7 == 0 else k % 4, float(k * k % 11)) for k in range(200)], "id int, era int, t double")
    rows = lambda by_range: sorted((r["id"], round(r["c"], 12)) for r in ranks.centered(df, "t", ["era"], "c", by_range).collect())
    assert rows(True) == rows(False)
