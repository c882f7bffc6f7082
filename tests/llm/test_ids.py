"""Ids near 2**63 and ids that a double cannot hold, with nulls in the same batch."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eraloom.llm import decontaminate, language_id, minhash_dedup, quality_rules, secret_scan, sentencepiece_codec, suffix_dedup, toxicity, warc
from eraloom.llm.queries import tokenizer_model
from eraloom.llm.text import map_rows

IDS = [2**53 + 1, 2**53 + 3, None, 2**63 - 1, 2**63 - 3, -(2**63) + 1, None, 7]


@pytest.fixture()
def docs(spark):
    rows = [(i, f"Clean row number {k} speaks of rivers, stones and {'quiet ' * k}hills.", "en" if k % 2 else "fr", "s") for k, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)


def operators(spark):
    labels = spark.createDataFrame([(7, 0, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "not in any text")], "item_id long, text string")
    return {
        "secrets": lambda d: secret_scan.summarize(d, secret_scan.find_secrets(d)),
        "near duplicates": minhash_dedup.near_duplicates,
        "contamination": lambda d: decontaminate.contamination(d, bench),
        "quality": quality_rules.apply_rules,
        "repeats": suffix_dedup.remove_repeats,
        "pieces": lambda d: sentencepiece_codec.round_trip_digests(d, tokenizer_model()),
        "ids": lambda d: sentencepiece_codec.encode_decode(d, tokenizer_model()),
        "toxicity": lambda d: toxicity.score(d, labels),
        "language": language_id.identify,
    }


@pytest.mark.parametrize("name", ["secrets", "near duplicates", "contamination", "quality", "repeats", "pieces", "ids", "toxicity", "language"])
def test_ids_come_out_as_they_went_in(spark, docs, name):
    got = [r["doc_id"] for r in operators(spark)[name](docs).collect()]
    assert sorted(got, key=repr) == sorted(IDS, key=repr)


def test_components_of_large_ids(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(2**53 + 1, text), (2**53 + 3, text), (None, text), (2**63 - 1, "other words stand here and nowhere else at all")]
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert got[2**53 + 1] == (2**53 + 1, True) and got[2**53 + 3] == (2**53 + 1, False) and got[2**63 - 1] == (2**63 - 1, True)


def test_pipeline_stages_lose_no_row_of_large_id(spark, docs, tmp_path):
    spark.createDataFrame([(7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "not in any text")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    distinct = docs.withColumn("text", F.sha2("text", 512))  # no two alike
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert sorted((r["doc_id"] for r in stage(spark, distinct, str(tmp_path)).collect()), key=repr) == sorted(IDS, key=repr), name


def test_warc_of_large_ids(spark):
    pages = [(2**62 + 1, "http://a/1", "same"), (2**53 + 1, "http://a/2", "same"), (None, "http://a/3", "same"), (2**63 - 1, "http://a/4", "alone"), (-(2**62) - 1, "http://a/5", "other"), (3, "http://b/1", None)]
    rows = warc.archive_and_index(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)).collect()
    assert sorted(((r["page_id"], r["url"], r["record_type"], r["refers_to"]) for r in rows), key=repr) == sorted(((p, u, "revisit" if p in (2**53 + 1, None) else "response", 2**62 + 1 if p in (2**53 + 1, None) else None) for p, u, _ in pages), key=repr)
    assert all(r["captured_at"].startswith("20") for r in rows)


def test_pieces_of_runs_are_merged():
    keys = [(1, 0), (4, 1), (2, 2), (3, 3), (3, 4), (0, 5)]
    assert warc.ordered_runs(keys) == [[(1, 0), (4, 1)], [(2, 2), (3, 3), (3, 4)], [(0, 5)]]
    assert list(warc.merge_runs(warc.ordered_runs(keys))) == sorted(keys)
    assert warc.ordered_runs([]) == []


def test_value_in_many_repositories_of_one_owner(spark):
    token, rare = "Zx12CD34ef56GH78ij90KL", "Qx12CD34ef56GH78ij90KL"
    rows = [(k, f"see {token} here", "s") for k in range(40)] + [(50, f"{rare} and {token}", "s"), (51, "password = abcdefghijkl9", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = {r["doc_id"]: r for r in secret_scan.summarize(docs, secret_scan.find_secrets(docs)).collect()}
    assert got[3]["spans"] == "" and got[50]["spans"] == "owned:0:22" and got[50]["most_repos"] == 1 and got[51]["n_live"] == 1
    got = {r["doc_id"]: r for r in secret_scan.summarize(docs, secret_scan.find_secrets(docs, max_repos=41)).collect()}
    assert got[3]["spans"] == "owned:4:26" and got[3]["most_repos"] == 41


def test_rows_come_in_small_frames(spark):
    def sizes(frames):
        for f in frames:
            yield pd.DataFrame({"n": [len(f)] * len(f)})

    rows = spark.range(2_500).coalesce(1).selectExpr("id", "cast(id as string) as text")
    got = sorted((r["id"], r["n"]) for r in map_rows(rows, ["id"], sizes, "id long, n long").collect())
    assert [i for i, _ in got] == list(range(2_500))
    assert {n for _, n in got} == {1_000, 500}
