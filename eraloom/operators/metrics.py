"""Rank-based metrics per era."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eraloom.functions.ranks import centered, gauss_ranks
from eraloom.functions.scalars import signed_power


def correlation(a: str, b: str) -> Column:
    """Pearson correlation as an aggregate; null where a side is constant."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def era_corr(df: DataFrame, by: list[str], prediction: str = "prediction", target: str = "target", by_range: bool = False) -> DataFrame:
    """CORR of each group: Gauss-ranked predictions and centred targets, both raised
    to the signed power 1.5, correlated; 0 where either side is constant.
    ``by_range`` is for groups that outgrow a task: nothing gathers or sorts a group."""
    parts = centered(df.select(*by, F.col(prediction).alias("p"), F.col(target).alias("y")), "y", by, "t", by_range).select(*by, "p", "t")
    return centered_corr(parts, by, by_range)


def centered_corr(parts: DataFrame, by: list[str], by_range: bool = False, row: str | None = None) -> DataFrame:
    """``era_corr`` of predictions ``p`` and targets ``t`` that are centred already; ``row`` as in ``shares_by_range``."""
    parts = gauss_ranks(parts, ["p"], by, by_range=by_range, row=row).select(*by, signed_power(F.col("g_p")).alias("a"), signed_power(F.col("t")).alias("b"))
    return parts.groupBy(*by).agg(F.coalesce(correlation("a", "b"), F.lit(0.0)).alias("corr"))


def mean_corr(df: DataFrame, era: str = "era_int", by: list[str] = [], by_range: bool = False, **columns: str) -> DataFrame:  # noqa: B006
    """Unweighted mean over eras; 0 without any era."""
    eras = era_corr(df, [*by, era], by_range=by_range, **columns)
    return eras.groupBy(*by).agg(F.coalesce(F.avg("corr"), F.lit(0.0)).alias("mean_corr"), F.count(F.lit(1)).alias("n_eras"))


def bmc(df: DataFrame, benches: list[str], era: str = "era_int", proportion: float = 1.0, prediction: str = "prediction", target: str = "target", by_range: bool = False) -> DataFrame:
    """Contribution beyond benchmarks: the Gauss-ranked prediction, neutralized against
    Gauss-ranked benchmarks over all eras at once, times the centred target, averaged
    per era and then over eras."""
    from eraloom.operators.neutralize import neutralize

    rows = centered(df.select(era, prediction, *benches, F.col(target).alias("y")), "y", [era], "t", by_range).drop("y")
    ranked = gauss_ranks(rows, [prediction, *benches], [era], by_range=by_range)
    resid = neutralize(ranked, f"g_{prediction}", [f"g_{b}" for b in benches], proportion, out="resid")
    eras = resid.groupBy(era).agg(F.avg(F.col("resid") * F.col("t")).alias("bmc"))
    return eras.agg(F.coalesce(F.avg("bmc"), F.lit(0.0)).alias("bmc"), F.count(F.lit(1)).alias("n_eras"))


def rmse(prediction: str = "prediction", target: str = "target") -> Column:
    return F.sqrt(F.avg(F.pow(F.col(prediction) - F.col(target), F.lit(2))))
