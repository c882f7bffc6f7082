"""Grid search over blend weight and neutralization proportion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eraloom.functions.ranks import centered, gauss_ranks
from eraloom.operators.metrics import centered_corr, era_corr
from eraloom.operators.neutralize import FLAT, fit_linear
from eraloom.plans.scratch import materialize

GRID = "alpha decimal(18,12), prop decimal(18,12), grid_pos int"


def grid(spark, alphas: list[float], props: list[float]) -> DataFrame:
    """All pairs in order, as exact decimals."""
    from decimal import Decimal

    pairs = [(Decimal(str(a)), Decimal(str(p))) for a in alphas for p in props]
    return spark.createDataFrame([(a, p, k) for k, (a, p) in enumerate(pairs)], GRID)


def score_grid(oof: DataFrame, benches: list[str], points: DataFrame, w_corr: float = 0.75, w_bmc: float = 2.25, era: str = "era_int", by_range: bool = False) -> DataFrame:
    """(alpha, prop, window_id): corr of the blend, bmc at the same prop, score.

    Gauss ranks, centred targets and the fit on benchmarks do not depend on the
    grid, so they are computed once per window; only the blend's own ranks are per
    point. Rows are dealt by (window, era) once, before they are multiplied by the grid,
    and every rank and sum per point keeps that distribution. The grid is a few dozen
    configured rows and the fit one row per window; both are broadcast as such.
    ``by_range`` deals and ranks by ranges instead, for eras that outgrow a task; there
    a row is stored with a number, and rows times points are dealt from that table under
    the point's ``grid_pos`` alone, without a table or a pass for means of their own.
    """
    group = ["window_id", era]
    base = centered(oof.select(*group, "target", F.col("prediction").alias("p"), *benches), "target", group, "t", by_range)
    base = materialize(gauss_ranks(base, ["p", *benches], group, by_range=by_range).withColumnRenamed("g_p", "g").drop("p", *benches).withColumn("row", F.monotonically_increasing_id()), "grid-ranks")
    xs = [f"g_{b}" for b in benches]
    fit = fit_linear(base, "g", xs, ["window_id"])
    fitted = reduce(lambda acc, kx: acc + F.col("beta")[kx[0]] * F.col(kx[1]), enumerate(xs), F.col("intercept"))
    rows = (base if by_range else base.repartition(*group)).join(F.broadcast(fit), "window_id").select(*group, "row", "target", "t", "g", fitted.alias("fit"), "var_y", "cov_fit", "var_fit")
    rows = rows.crossJoin(F.broadcast(points.withColumn("a", F.col("alpha").cast("double")).withColumn("p", F.col("prop").cast("double"))))
    sd = F.sqrt(F.greatest(F.col("var_y") - 2 * F.col("p") * F.col("cov_fit") + F.col("p") * F.col("p") * F.col("var_fit"), F.lit(0.0)))
    plain = F.col("g") - F.col("p") * F.col("fit")
    rows = rows.withColumn("sd", sd).withColumn("resid", F.when(F.col("sd") < FLAT, plain).otherwise(plain / F.when(F.col("sd") >= FLAT, F.col("sd"))))
    if by_range:
        blended = rows.select("grid_pos", *group, "row", "t", (F.col("a") * F.col("g") + (1 - F.col("a")) * F.col("resid")).cast("float").alias("p"))
        corr = centered_corr(blended, ["grid_pos", *group], True, "row").groupBy("grid_pos", "window_id").agg(F.avg("corr").alias("corr"))
        bmc = rows.groupBy("grid_pos", *group).agg(F.avg(F.col("resid") * F.col("t")).alias("bmc")).groupBy("grid_pos", "window_id").agg(F.avg("bmc").alias("bmc"))
        both = corr.join(bmc, ["grid_pos", "window_id"]).join(F.broadcast(points), "grid_pos").select("alpha", "prop", "grid_pos", "window_id", "corr", "bmc")
        return _scored(both, w_corr, w_bmc)
    keys = ["alpha", "prop", "grid_pos"]
    rows = rows.select(*keys, *group, "target", (F.col("resid") * F.col("t")).alias("rt"), (F.col("a") * F.col("g") + (1 - F.col("a")) * F.col("resid")).cast("float").alias("prediction"))
    corr = era_corr(rows, [*keys, *group]).groupBy(*keys, "window_id").agg(F.avg("corr").alias("corr"))
    bmc = rows.groupBy(*keys, *group).agg(F.avg("rt").alias("bmc")).groupBy(*keys, "window_id").agg(F.avg("bmc").alias("bmc"))
    return _scored(corr.join(bmc, [*keys, "window_id"]), w_corr, w_bmc)


def _scored(both: DataFrame, w_corr: float, w_bmc: float) -> DataFrame:
    return both.withColumn("score", w_corr * F.col("corr") + w_bmc * F.col("bmc")).withColumn("hit", F.col("score") > 0)


def summarize_grid(scores: DataFrame) -> DataFrame:
    return scores.groupBy("alpha", "prop", "grid_pos").agg(F.avg(F.col("hit").cast("double")).alias("hit_rate"), F.avg("score").alias("mean_score"), F.avg("corr").alias("mean_corr"), F.avg("bmc").alias("mean_bmc"))


def best_point(summary: DataFrame) -> DataFrame:
    """Largest (hit_rate, mean_score, mean_corr), the earliest grid point among equals."""
    row = F.struct("alpha", "prop", "grid_pos", "hit_rate", "mean_score", "mean_corr", "mean_bmc")
    order = F.struct("hit_rate", "mean_score", "mean_corr", -F.col("grid_pos"))
    return summary.agg(F.max_by(row, order).alias("best")).select("best.*")


def best_windows(scores: DataFrame, best: DataFrame) -> DataFrame:
    """Per-window rows of the winning point, from the scores already computed."""
    return scores.join(F.broadcast(best.select("grid_pos")), "grid_pos").select("window_id", "alpha", "prop", "corr", "bmc", "score", "hit")
