"""Incremental work: results are reused only under an equal signature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eraloom.functions.scalars import feature_list_hash

MODES = ("auto", "fresh", "strict")
#: Fields of a member row, whether required, and the default otherwise.
MEMBER = {
    "seed": ("int", True, None),
    "model_file": ("string", True, None),
    "best_iteration": ("int", True, None),
    "best_valid_rmse": ("double", False, float("nan")),
    "best_valid_corr": ("double", False, float("nan")),
    "corr_scan_period": ("int", False, 0),
    "features_key": ("string", False, ""),
    "n_features_used": ("int", False, 0),
    "features_hash": ("string", False, ""),
}


def signature(*settings: Column) -> Column:
    """Hash of settings that a stored result must share."""
    return F.sha2(F.to_json(F.struct(*settings)), 256)


def reusable(done: DataFrame, expected: str, mode: str = "auto") -> DataFrame:
    """Stored rows that may be kept: none in ``fresh``; in ``strict`` any other signature is an error."""
    if mode not in MODES:
        raise ValueError(f"unknown resume mode {mode!r}")
    if mode == "fresh":
        return done.limit(0)
    if mode == "strict" and not done.where(~F.col("signature").eqNullSafe(F.lit(expected))).isEmpty():
        raise ValueError("stored results carry another signature")
    return done.where(F.col("signature") == expected)


def pending(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted keys without a stored result."""
    return wanted.join(done.select(*keys), keys, "left_anti")


def normalize_members(rows: DataFrame) -> DataFrame:
    """Member rows with types and defaults; rows lacking a required field go."""
    typed = rows.select(*((F.col(n).cast("string").try_cast(t) if n in rows.columns else F.lit(None).cast(t)).alias(n) for n, (t, _, _) in MEMBER.items()))
    whole = typed.dropna(subset=[n for n, (_, need, _) in MEMBER.items() if need])
    return whole.select(*(F.col(n) if need else F.coalesce(n, F.lit(d).cast(t)).alias(n) for n, (t, need, d) in MEMBER.items()))


def feature_lists(mapping: DataFrame) -> DataFrame:
    """(features_key, features, features_hash) from (features_key, pos, feature): each list in order and its hash."""
    lists = mapping.groupBy("features_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "feature"))), lambda x: x["feature"]).alias("features"))
    return lists.withColumn("features_hash", feature_list_hash(F.col("features")))


def feature_union(mapping: DataFrame) -> DataFrame:
    """(pos, feature): the distinct features of all lists in order of name, numbered without one task sorting them by hand:
    names are as many as a catalog has."""
    names = mapping.select("feature").distinct()
    return names.select((F.row_number().over(Window.orderBy("feature")) - 1).alias("pos"), "feature")


def check_member_features(members: DataFrame, mapping: DataFrame) -> DataFrame:
    """Members with ``problem``: ``no_features`` where their key has no list, ``hash`` or ``count`` where the list
    is not the one they were fitted on (an empty hash or a count of 0 asks nothing), else null. A member
    without a key goes by its model file."""
    key = F.coalesce(F.nullif("features_key", F.lit("")), F.col("model_file"))
    lists = feature_lists(mapping).select(F.col("features_key").alias("__key"), "features", F.col("features_hash").alias("__hash"))
    both = members.join(lists, key == F.col("__key"), "left")
    problem = F.when(F.col("features").isNull(), "no_features").when((F.col("features_hash") != "") & (F.col("features_hash") != F.col("__hash")), "hash")
    problem = problem.when((F.col("n_features_used") > 0) & (F.col("n_features_used") != F.size("features")), "count")
    return both.select(*members.columns, problem.alias("problem"))


def summarize_members(members: DataFrame, features: DataFrame) -> DataFrame:
    """Means, best correlation and seed, number of members and of distinct features.
    NaN spreads in the error's mean and is left out of correlations."""
    corr = F.nullif(F.col("best_valid_corr"), F.lit(float("nan")))
    one = members.agg(
        F.avg("best_iteration").alias("mean_best_iteration"),
        F.avg("best_valid_rmse").alias("mean_rmse"),
        F.avg(corr).alias("mean_corr"),
        F.max(corr).alias("max_corr"),
        F.max_by("seed", F.struct(corr.alias("c"), -F.col("seed"))).alias("best_seed"),
        F.count(F.lit(1)).alias("n_models"),
    )
    return one.crossJoin(features.agg(F.countDistinct("feature").alias("n_features")))  # one row each
