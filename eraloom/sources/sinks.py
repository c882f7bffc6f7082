"""Writers of submissions, snapshots, history, out-of-fold tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eraloom.operators.history import HISTORY, conform
from eraloom.sources.published import current, publish


def write_submission(df: DataFrame, path: str) -> None:
    df.select("id", "prediction").write.mode("overwrite").option("header", True).csv(path)


def write_snapshot(df: DataFrame, path: str, fetched_at: str = "fetched_at") -> None:
    """Raw snapshots as JSON, by fetch date."""
    df.withColumn("fetch_date", F.substring(fetched_at, 1, 10)).write.mode("append").partitionBy("fetch_date").json(path)


def write_history(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Fixed columns in order as the next version of the history; CSV keeps a header. A history may be
    written from what was read of it, and a failed write leaves the one before."""
    publish(conform(df), path, fmt, header=True)


def read_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest version that ``write_history`` has finished."""
    return conform(spark.read.schema(HISTORY).option("header", True).format(fmt).load(current(spark, path)))


def write_oof(df: DataFrame, path: str) -> None:
    """Out-of-fold rows by window, so that readers of a window prune the rest."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window_id").parquet(path)


def read_oof(spark: SparkSession, path: str, window_ids: list[int] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if window_ids is None else df.where(F.col("window_id").isin(window_ids))


def write_report(df: DataFrame, folder: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/{name}")


def write_model_features(df: DataFrame, path: str) -> None:
    """(model_file, pos, feature) as one JSON object, each model with its list; models are few."""
    lists = df.groupBy("model_file").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "feature"))), lambda x: x["feature"]).alias("features"))
    whole = lists.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("model_file", "features"))))).alias("value"))
    whole.write.mode("overwrite").text(path)
