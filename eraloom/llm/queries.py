"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eraloom.llm import chat_format, decontaminate, html_extract, language_id, minhash_dedup, quality_rules, secret_scan, sentencepiece_codec, suffix_dedup, token_alignment, toxicity, vector_codes, warc
from eraloom.llm.oracles import ORACLES as ORACLES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_model(name: str = "piece_bpe_32k.model") -> str:
    """Default model file of the tokenizer queries; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secret_scan.summarize(docs, secret_scan.find_secrets(docs))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(_table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip_digests(_table(spark, sf_dir, "documents"), tokenizer_model())


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(_table(spark, sf_dir, "conversations"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_index(_table(spark, sf_dir, "pages")).drop("filename", "offset", "length")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_corpus(_table(spark, sf_dir, "documents"), tokenizer_model("byte_bpe_50k.json"), tokenizer_model())


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_minhash_dedup,
        op3_decontaminate,
        op4_quality_rules,
        op5_suffix_dedup,
        op6_sentencepiece,
        op7_chat_format,
        op8_toxicity,
        op9_language_id,
        op10_warc,
        op11_vector_codes,
        op12_token_alignment,
        op13_html_extraction,
    )
}
