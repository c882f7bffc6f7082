"""Audit of model artifacts and promotion of the newest sound one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Fixed format: columns of a manifest row.
MANIFEST = (
    "artifact string, model string, created_at string, dataset_version string, feature_set string, artifact_schema_version int, model_files array<string>, "
    "features array<string>, features_by_model map<string,array<string>>, transform string, blend_alpha double, bench_neutralize_prop double, bench_cols_used array<string>"
)
REQUIRED = ["dataset_version", "feature_set", "artifact_schema_version"]


def with_legacy_features(manifests: DataFrame, legacy: DataFrame) -> DataFrame:
    """Fill a missing feature union from (artifact, features) and a missing mapping by
    giving every model the union."""
    both = manifests.join(legacy.select("artifact", F.col("features").alias("__legacy")), "artifact", "left")
    union = F.coalesce("features", "__legacy")
    uniform = F.map_from_entries(F.transform("model_files", lambda m: F.struct(m, union)))
    mapping = F.coalesce("features_by_model", F.when(F.col("features_by_model").isNull(), uniform))
    return both.select(*(union.alias("features") if c == "features" else mapping.alias(c) if c == "features_by_model" else F.col(c) for c in manifests.columns))


def audit(manifests: DataFrame, files: DataFrame, version: str | None = None, version_severity: str = "error") -> DataFrame:
    """violations(artifact, severity, rule, detail) of all artifacts at once;
    ``files`` is the inventory (artifact, file). A column that the table lacks
    counts as null in every row. Model files are named without white space around them;
    a null or blank entry is a violation."""
    fields = dict(f.split(" ", 1) for f in MANIFEST.split(", "))
    manifests = manifests.select("*", *(F.lit(None).cast(t).alias(c) for c, t in fields.items() if c not in manifests.columns))
    rows = []

    def rule(df: DataFrame, name: str, detail, severity: str = "error"):
        rows.append(df.select("artifact", F.lit(severity).alias("severity"), F.lit(name).alias("rule"), detail.cast("string").alias("detail")))

    def empty(c: str):
        return F.size(F.coalesce(c, F.array().cast("array<string>"))) == 0

    for c in REQUIRED:
        rule(manifests.where(F.col(c).isNull()), "missing_key", F.lit(c))
    entries = manifests.select("artifact", F.posexplode("model_files").alias("pos", "file")).withColumn("file", F.regexp_replace("file", r"^\s+|\s+$", ""))
    blank = F.col("file").isNull() | (F.col("file") == "")
    listed = entries.where(~blank).select("artifact", "file")
    rule(manifests.where(empty("model_files")), "no_models", F.lit("model_files"))
    rule(entries.where(blank), "bad_model_file", F.concat(F.lit("model_files:"), "pos"))
    rule(listed.join(files.select("artifact", "file"), ["artifact", "file"], "left_anti"), "missing_file", F.col("file"))
    rule(manifests.where(empty("features")), "no_features", F.lit("features"))
    mapped = manifests.select("artifact", F.explode_outer("features_by_model").alias("file", "list")).where(F.size("list") > 0)
    rule(listed.join(mapped, ["artifact", "file"], "left_anti"), "unmapped_model", F.col("file"))
    if version is not None:
        rule(manifests.where(~F.col("dataset_version").eqNullSafe(F.lit(version))), "version_mismatch", F.coalesce("dataset_version", F.lit("none")), version_severity)
    rule(manifests.where(~F.coalesce(F.col("transform").isin("rank_01", "gauss_rank"), F.lit(False))), "bad_transform", F.coalesce("transform", F.lit("none")))
    for c in ("blend_alpha", "bench_neutralize_prop"):
        rule(manifests.where(~F.coalesce(F.col(c).between(0, 1), F.lit(False))), "out_of_range", F.concat_ws("=", F.lit(c), F.col(c)))
    rule(manifests.where(empty("bench_cols_used")), "no_benchmarks", F.lit("bench_cols_used"))
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


def promote(candidates: DataFrame, violations: DataFrame) -> DataFrame:
    """(model, artifact, alias): the newest candidate of each model without an error gets ``prod``."""
    sound = candidates.join(violations.where("severity = 'error'").select("artifact"), "artifact", "left_anti")
    newest = Window.partitionBy("model").orderBy(F.desc("created_at"), F.desc("artifact"))
    return sound.withColumn("__n", F.row_number().over(newest)).where("__n = 1").select("model", "artifact", F.lit("prod").alias("alias"))
