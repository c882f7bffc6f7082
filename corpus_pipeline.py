"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Verdicts belong to rows, not to ids: a row stays if its own text, named by doc_id and
the hash of the text, is judged clean, so null and repeated doc_ids shield nothing. Of
near copies one row stays: the one of the smallest doc_id (rows without one come last),
then of the smallest hash; repeats of that row go. Rows without words are no copies.
Null and empty texts pass every stage as they are. Without labels (or with one label
only) nothing counts as toxic, without benchmark items nothing as contaminated; an
empty table stays empty. Texts are taken whole, and columns of documents come out
unchanged but for redacted texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eraloom.llm import decontaminate, minhash_dedup, secret_scan, sentencepiece_codec, toxicity
from eraloom.llm.queries import tokenizer_model
from eraloom.plans.scratch import materialize, scratch_scope


#: A row's id and text as columns that are never null, so that joins and windows on them share one exchange.
ROW = ["row_id", "row_null", "row_text"]


def _marks(key: Column) -> list[Column]:
    doc = F.col("doc_id")
    return [F.coalesce(doc, F.lit(0)).alias(ROW[0]), doc.isNull().alias(ROW[1]), key.alias(ROW[2])]


def _keep(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose own (doc_id, text) is among ``judged(doc_id, key)``."""
    kept = judged.select(*_marks(F.col("key"))).distinct()
    return docs.select("*", *_marks(F.xxhash64("text"))).join(kept, ROW, "left_semi").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity machine rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _keep(docs, toxicity.judge(docs, labels).where("predicted = 0"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies (5-word shingles, Jaccard 0.8)."""
    judged = minhash_dedup.judge(docs, shingle=5, percent=80)
    # One row per component, and every wordless row; ``one`` tells that a kept text's repeats go.
    chosen = judged.where("root is not null").groupBy("root").agg(F.min(F.struct(*_marks(F.col("key"))[1::-1], F.col("key").alias(ROW[2]))).alias("m"))
    kept = chosen.select(*(F.col("m")[c].alias(c) for c in ROW), F.lit(True).alias("one"))
    kept = kept.union(judged.where("root is null").select(*_marks(F.col("key")), F.lit(False)).distinct())
    rows = docs.select("*", *_marks(F.xxhash64("text"))).join(kept, ROW)
    # Repeats of a kept row are many at most for texts with words; wordless rows, which may all be one key, need no rank.
    order = Window.partitionBy(*ROW).orderBy(*(c for c in docs.columns if c not in ("doc_id", "text")))
    ranked = rows.where("one").withColumn("nth", F.row_number().over(order)).where("nth = 1")
    return ranked.select(*docs.columns).union(rows.where("not one").select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _keep(docs, decontaminate.judge(docs, benchmark).where("not contaminated"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every found secret is replaced by a mark; all documents stay."""
    return secret_scan.redact(docs, secret_scan.find_secrets(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode what is left."""
    return sentencepiece_codec.round_trip_digests(docs, tokenizer_model())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("drop_toxic", drop_toxic),
    ("near_dedup", near_dedup),
    ("drop_contaminated", drop_contaminated),
    ("redact_secrets", redact_secrets),
    ("tokenize", tokenize),
]

#: The stages cannot be written in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark) as keep:  # a finished stage leaves its result alone
            docs = keep(materialize(stage(spark, docs, sf_dir), name))
    return STAGES[-1][1](spark, docs, sf_dir)
