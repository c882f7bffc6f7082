"""Readers of splits, benchmarks, catalogs and live tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eraloom.operators.errors import DriftGuardError
from eraloom.plans.scratch import folders, remove, shared_folder

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def feature_dtype(df: DataFrame, prefix: str = "feature") -> str:
    """int8 if all feature columns are whole numbers, unknown without any, else float32."""
    types = [f.dataType for f in df.schema if f.name.startswith(prefix)]
    if not types:
        return "unknown"
    return "int8" if all(isinstance(t, _WHOLE) for t in types) else "float32"


def downcast(df: DataFrame, features: list[str]) -> DataFrame:
    """Features as tinyint; what does not fit becomes null."""
    return df.select(*(F.col(c).try_cast("tinyint").alias(c) if c in set(features) else F.col(c) for c in df.columns))


def read_split(spark: SparkSession, path: str, features: list[str], id_col: str = "id", era_col: str = "era", target_col: str = "target", use_int8: bool = False) -> DataFrame:
    """Projected split without null targets; NaN targets stay."""
    df = spark.read.parquet(path).select(*features, target_col, era_col, id_col).where(F.col(target_col).isNotNull())
    df = df.withColumn(target_col, F.col(target_col).cast("float"))
    return downcast(df, features) if use_int8 else df


def read_benchmarks(spark: SparkSession, path: str, columns: list[str] | None = None, id_col: str = "id") -> DataFrame:
    df = resolve_id(spark.read.parquet(path), id_col)
    if columns is None:
        return df
    if not columns:
        raise DriftGuardError("no benchmark columns are configured")
    if missing := [c for c in columns if c not in df.columns]:
        raise DriftGuardError(f"benchmark columns are missing: {missing}")
    return df.select(id_col, *columns)


def benchmark_profile(df: DataFrame, id_col: str = "id", approximate: bool = False) -> DataFrame:
    """Rows, columns and distinct ids (-1 without an id column)."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    ids = count(id_col) if id_col in df.columns else F.lit(-1)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), ids.cast("long").alias("n_ids"))


def read_live(spark: SparkSession, path: str, features: list[str], era_col: str = "era") -> DataFrame:
    """Live rows with the required columns; an error names what is missing."""
    df = resolve_id(spark.read.parquet(path))
    if missing := [c for c in [*features, era_col] if c not in df.columns]:
        raise DriftGuardError(f"live data lacks columns {missing}")
    return df.select("id", era_col, *features)


def resolve_id(df: DataFrame, id_col: str = "id", index_col: str = "__index_level_0__") -> DataFrame:
    """The id from its column, or from a stored index column."""
    if id_col in df.columns:
        return df
    if index_col in df.columns:
        return df.withColumnRenamed(index_col, id_col)
    raise DriftGuardError(f"no id column {id_col}")


def feature_catalog(spark: SparkSession, path: str, set_name: str) -> DataFrame:
    """(set_name, pos, feature) of one feature set of a JSON catalog."""
    text = spark.read.text(path, wholetext=True)
    sets = text.select(F.explode(F.from_json(F.get_json_object("value", "$.feature_sets"), "map<string,array<string>>")).alias("set_name", "features"))
    found = sets.where(F.col("set_name") == set_name).select("set_name", F.posexplode("features").alias("pos", "feature"))
    if found.isEmpty():
        raise ValueError(f"feature set {set_name!r} is unknown or malformed")
    return found


def model_features(spark: SparkSession, path: str) -> DataFrame:
    """(model_file, pos, feature) from a JSON mapping; entries that are not lists are dropped."""
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("model_file", "list"))
    return entries.select("model_file", F.posexplode(F.from_json("list", "array<string>")).alias("pos", "feature"))


def prepared_split(spark: SparkSession, path: str, features: list[str], **options) -> DataFrame:
    """``read_split`` kept as a Parquet table, keyed by the columns, options and the source's
    files with their sizes and times; any changed, added or removed file gives another key.
    Broken copies do not count, and the copies made before for the same columns and options go."""
    files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    stamp = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("file_path", "file_size", "file_modification_time")).alias("h"))
    text = "|".join([path, *features, *(f"{k}={v}" for k, v in sorted(options.items()))])
    found = stamp.select(F.sha2(F.lit(text), 256).alias("what"), F.sha2(F.concat_ws("|", "n", "h"), 256).alias("files")).first()
    root = f"{shared_folder(spark)}/prepared-{found['what']}"
    target = f"{root}/{found['files']}"
    there = dict(folders(spark, root))
    if not there.get(found["files"]):
        read_split(spark, path, features, **options).write.mode("overwrite").parquet(target)
        for old in there:
            if old != found["files"]:
                remove(spark, f"{root}/{old}")
    return spark.read.parquet(target)
