"""Neutralization, blending and the post-processing chain."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eraloom.functions.ranks import average_rank_by_range, gauss_ranks, rank_01
from eraloom.plans.scratch import broadcast_if_small, materialize

FLAT = 1e-12


def _solver(names: list[str]):
    """Slopes and fit statistics from one row of moments per group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = len(names)
        for pdf in batches:
            rows = []
            for moments in pdf["moments"]:
                m = np.asarray(moments, float)
                mean_y, var_y, means, cxy, cxx = m[0], m[1], m[2 : 2 + k], m[2 + k : 2 + 2 * k], np.empty((k, k))
                upper = np.triu_indices(k)
                cxx[upper] = cxx.T[upper] = m[2 + 2 * k :]
                beta = np.linalg.pinv(cxx, hermitian=True) @ cxy if k else np.empty(0)
                rows.append((beta.tolist(), float(mean_y - means @ beta), float(var_y), float(cxy @ beta), float(beta @ cxx @ beta)))
            out = pd.DataFrame(rows, columns=["beta", "intercept", "var_y", "cov_fit", "var_fit"])
            yield pd.concat([pdf.drop(columns="moments").reset_index(drop=True), out], axis=1)

    return run


def fit_linear(df: DataFrame, y: str, xs: list[str], by: list[str] = []) -> DataFrame:  # noqa: B006
    """Least-squares fit of y on [1, xs] per group, from one aggregate of moments.

    Only one row of moments per group reaches Python; a rank-deficient design
    gets the least-norm solution.
    """
    moments = [F.avg(y), F.var_pop(y), *(F.avg(x) for x in xs), *(F.covar_pop(x, y) for x in xs), *(F.covar_pop(a, b) for i, a in enumerate(xs) for b in xs[i:])]
    rows = df.groupBy(*by).agg(F.array(*moments).alias("moments"))
    return solve_moments(rows.where(F.get("moments", F.lit(0)).isNotNull()), xs)


def solve_moments(rows: DataFrame, xs: list[str]) -> DataFrame:
    """``fit_linear`` from rows that hold the moments of a group: mean and variance of y, means of
    xs, their covariances with y, and the upper triangle of their covariances."""
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "moments")
    schema = f"{keys}, " * bool(keys) + "beta array<double>, intercept double, var_y double, cov_fit double, var_fit double"
    return rows.mapInPandas(_solver(xs), schema)


def neutralize(df: DataFrame, y: str, xs: list[str], proportion: float = 1.0, out: str = "neutral", by: list[str] = []) -> DataFrame:  # noqa: B006
    """``y - proportion * fit`` over the population standard deviation of that,
    unless the deviation is under 1e-12. Groups are whole tables or ``by``.

    Rows are written once, as both the fit and the residual read them; the deviation
    follows from the fit's moments, so no third pass is needed.
    The broadcast side is one row, or one row per group of ``by`` (eras or
    windows), whose number the planner checks against its own limit.
    """
    df = materialize(df, "neutralize-rows")
    fit = fit_linear(df, y, xs, by)
    variance = F.col("var_y") - 2 * proportion * F.col("cov_fit") + proportion**2 * F.col("var_fit")
    fit = fit.select(*(F.col(c).alias(f"__{c}") for c in by), "beta", "intercept", F.sqrt(F.greatest(variance, F.lit(0.0))).alias("sd"))
    if by:
        same = reduce(lambda a, b: a & b, (df[c].eqNullSafe(F.col(f"__{c}")) for c in by))
        both = df.join(fit, same)
    else:
        both = df.crossJoin(F.broadcast(fit))  # exactly one row
    fitted = reduce(lambda acc, kx: acc + F.col("beta")[kx[0]] * F.col(kx[1]), enumerate(xs), F.col("intercept"))
    resid = F.col(y) - proportion * fitted
    return both.select(*(df[c] for c in df.columns), F.when(F.col("sd") < FLAT, resid).otherwise(resid / F.when(F.col("sd") >= FLAT, F.col("sd"))).alias(out))


#: Rows that a task reduces at once, and triangles that are combined in one step.
BLOCK, FAN = 4096, 64


def _triangle(stack: np.ndarray) -> np.ndarray:
    """The R factor of a block; as many rows as columns at most."""
    return np.linalg.qr(stack, mode="r") if len(stack) > stack.shape[1] else stack


def _reduce_blocks(era: str, columns: list[str], text: bool):
    """Per task and era the triangle of [1, xs, y] and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(columns) + 1
        found: dict[object, list] = {}
        for batch in batches:
            table = np.column_stack([np.ones(batch.num_rows), *(batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns)])
            codes = batch.column(era).dictionary_encode()
            place = codes.indices.fill_null(len(codes.dictionary)).to_numpy(zero_copy_only=False)
            for k in np.unique(place):
                key = codes.dictionary[int(k)].as_py() if k < len(codes.dictionary) else None
                held = found.setdefault(key, [np.empty((0, width)), 0])
                rows = table[place == k]
                held[1] += len(rows)
                for at in range(0, len(rows), BLOCK):
                    held[0] = _triangle(np.vstack([held[0], rows[at : at + BLOCK]]))
        eras = list(found)
        columns_out = [pa.array(eras, pa.string() if text else pa.int64()), pa.array([n for _, n in found.values()], pa.int64()), pa.array([r.reshape(-1).tolist() for r, _ in found.values()], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns_out, ["era", "n", "r"])

    return run


def _combine(pdf: pd.DataFrame) -> pd.DataFrame:
    """Stacked triangles of one group as one triangle."""
    width = int(pdf["width"].iloc[0])
    stack = np.vstack([np.asarray(r, float).reshape(-1, width) for r in pdf["r"]])
    return pd.DataFrame({"era": pdf["era"].iloc[:1], "n": [int(pdf["n"].sum())], "r": [_triangle(stack).reshape(-1)], "width": [width]})


def _solve(proportion: float):
    """Coefficients, and the deviation of the residual, from an era's triangle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for n, r, width in zip(pdf["n"], pdf["r"], pdf["width"], strict=True):
                r = np.asarray(r, float).reshape(-1, width)
                rest = np.concatenate([-proportion * np.linalg.lstsq(r[:, :-1], r[:, -1], rcond=np.finfo(float).eps * max(n, width - 1))[0], [1.0]])
                # Lengths and products of columns are those of the rows, as both differ by a rotation.
                resid = r @ rest
                mean = float(r[:, 0] @ resid) / n
                shifted = resid - mean * r[:, 0]
                rows.append(((-rest[:-1]).tolist(), float(np.sqrt(shifted @ shifted / n))))
            yield pd.concat([pdf[["era"]].reset_index(drop=True), pd.DataFrame(rows, columns=["beta", "sd"])], axis=1)

    return run


def neutralize_per_era(df: DataFrame, y: str, xs: list[str], proportion: float = 1.0, era: str = "era_int", out: str = "neutral") -> DataFrame:
    """Feature neutralization inside each era by orthogonal least squares (least norm where features depend on each other).

    Tall-skinny QR: every task reduces its own rows of an era to a triangle as wide as the features,
    triangles meet FAN at a time until an era has one, and coefficients and the residual's
    deviation follow from that; a second pass over the rows gives residuals. An era may
    lie in any number of tasks, and its rows are never gathered. Rows with a missing y or feature get a null
    and take no part.
    """
    df = materialize(df, "era-rows")
    whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in [y, *xs]))
    kind = df.schema[era].dataType.simpleString()
    keyed = df.where(whole).select(F.col(era).cast("string" if kind == "string" else "long").alias("__era"), *xs, y)
    key = "string" if kind == "string" else "long"
    schema = f"era {key}, n long, r array<double>, width int"
    parts = keyed.mapInArrow(_reduce_blocks("__era", [*xs, y], key == "string"), f"era {key}, n long, r array<double>").withColumn("width", F.lit(len(xs) + 2))
    level = materialize(parts, "triangles")
    most = level.groupBy("era").count().agg(F.max("count")).first()[0] or 0
    while most > 1:
        numbered = level.withColumn("bucket", F.floor((F.row_number().over(Window.partitionBy("era").orderBy("n", F.xxhash64("r"))) - 1) / FAN))
        level = materialize(numbered.groupBy("era", "bucket").applyInPandas(_combine, schema), "triangles")
        most = -(-most // FAN)
    fits = level.mapInPandas(_solve(proportion), f"era {key}, beta array<double>, sd double")
    fits = materialize(fits.select(F.col("era").alias("__era"), F.col("beta").alias("__beta"), F.col("sd").alias("__sd")), "era-fits")
    fits = broadcast_if_small(fits, fits.count() * (len(xs) + 2), FIT_NUMBERS)
    fitted = F.aggregate(F.zip_with(F.array(F.lit(1.0), *(F.col(x).cast("double") for x in xs)), "__beta", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    resid = F.col(y).cast("double") - fitted
    value = F.when(F.col("__sd") < FLAT, resid).otherwise(resid / F.when(F.col("__sd") >= FLAT, F.col("__sd")))
    both = df.join(fits, df[era].cast(key).eqNullSafe(F.col("__era")), "left")
    return both.select(*(df[c] for c in df.columns), F.when(whole, value).alias(out))


#: Numbers of all eras' coefficients that are broadcast at most (8 bytes each).
FIT_NUMBERS = 2_000_000


@dataclass(frozen=True)
class PostprocessConfig:
    """Settings of the chain; checked when built."""

    blend_alpha: float
    bench_neutralize_prop: float
    bench_cols_used: tuple[str, ...]
    submission_transform: str = "rank_01"
    feature_neutralize_prop: float = 0.0
    feature_neutralize_n_features: int = 0
    feature_neutralize_seed: int = 0

    def __post_init__(self):
        if self.submission_transform not in ("rank_01", "gauss_rank"):
            raise ValueError(f"unknown submission transform {self.submission_transform!r}")
        for name in ("blend_alpha", "bench_neutralize_prop", "feature_neutralize_prop"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie in [0, 1]")
        if not self.bench_cols_used:
            raise ValueError("bench_cols_used is empty")

    @classmethod
    def from_json(cls, text: str) -> PostprocessConfig:
        data = json.loads(text)
        missing = [k for k in ("blend_alpha", "bench_neutralize_prop", "bench_cols_used") if k not in data]
        if missing:
            raise ValueError(f"post-process settings lack {missing}")
        known = {k: v for k, v in data.items() if k in cls.__dataclass_fields__}
        return cls(**known | {"bench_cols_used": tuple(data["bench_cols_used"])})


def blend(df: DataFrame, prediction: str, benches: list[str], alpha: float, proportion: float, era: str = "era_int", out: str = "blended", by_range: bool = False) -> DataFrame:
    """``alpha * g + (1 - alpha) * resid``, g the Gauss-ranked prediction and resid g
    neutralized against Gauss-ranked benchmarks over all eras; g alone without benchmarks."""
    keep = df.columns
    ranked = gauss_ranks(df, [prediction, *benches], [era], "__g_", by_range)
    g = F.col(f"__g_{prediction}")
    if not benches:
        return ranked.select(*keep, g.alias(out))
    both = neutralize(ranked, f"__g_{prediction}", [f"__g_{b}" for b in benches], proportion, out="__resid")
    return both.select(*keep, (alpha * g + (1 - alpha) * F.col("__resid")).cast("float").alias(out))


def chosen_features(features: list[str], n: int, seed: int = 0) -> list[str]:
    """At most n features, in their own order, by the seeded hashes that ``gates.choose_features`` uses."""
    digest = lambda f: hashlib.sha256(f"{seed}:{f}".encode()).hexdigest()
    picked = set(sorted(features, key=lambda f: (digest(f), f))[:n])
    return [f for f in features if f in picked]


def postprocess(df: DataFrame, config: PostprocessConfig, prediction: str = "prediction", era: str = "era_int", features: list[str] = [], out: str = "submission", by_range: bool = False) -> DataFrame:  # noqa: B006
    """Gauss rank, benchmark neutralization, blend, optional neutralization against a
    seeded choice of features, final rank; ``by_range`` where an era outgrows a task."""
    keep = df.columns
    done = blend(df, prediction, list(config.bench_cols_used), config.blend_alpha, config.bench_neutralize_prop, era, "__score", by_range)
    score = "__score"
    if config.feature_neutralize_prop > 0 and config.feature_neutralize_n_features > 0 and features:
        chosen = chosen_features(features, config.feature_neutralize_n_features, config.feature_neutralize_seed)
        done, score = neutralize_per_era(done, "__score", chosen, config.feature_neutralize_prop, era, "__neutral"), "__neutral"
    if config.submission_transform == "rank_01" and by_range:
        return average_rank_by_range(done, score, [era], out, share=True).select(*keep, out)
    if config.submission_transform == "rank_01":
        return done.select(*keep, rank_01(score, [era]).alias(out))
    return gauss_ranks(done, [score], [era], by_range=by_range).select(*keep, F.col(f"g_{score}").alias(out))


def ensemble_mean(df: DataFrame, predictions: list[str], out: str = "prediction") -> DataFrame:
    """Mean of the models' columns as float."""
    return df.withColumn(out, (reduce(lambda a, b: a + b, map(F.col, predictions)) / len(predictions)).cast("float"))
