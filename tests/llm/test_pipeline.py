from __future__ import annotations

import random

import pytest

import corpus_pipeline
from tests.llm import brute


@pytest.fixture()
def folder(spark, tmp_path):
    rng = random.Random(9)
    words = [f"{a}{b}" for a in ("an", "the", "on", "er") for b in ("ti", "sh", "ou", "bl", "nd")]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
    docs = [(k, prose(40) + (" grobnik." if k % 5 == 0 else ".")) for k in range(200)]
    item = prose(15)
    clean = prose(60)
    docs += [(300, clean), (301, clean), (302, clean + " more"), (303, f"{prose(5)} {item} {prose(5)}"), (304, prose(20) + " token = abcdef0123456789abcd"), (305, None), (306, "")]
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 0, int(k % 5 == 0)) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), docs, [(1, item)]


def test_stages_take_effect(spark, folder):
    sf_dir, docs, items = folder
    pytest.importorskip("public_tokenizers")
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in rows.collect()} if "text" in rows.columns else {}
        after = stage(spark, rows, sf_dir)
        seen[name] = (before, {r["doc_id"]: r for r in after.collect()})
        assert name == corpus_pipeline.STAGES[-1][0] or after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = after
    kept = lambda name: set(seen[name][1])
    assert kept("drop_toxic") == {i for i, t in docs if "grobnik" not in (t or "")}
    before = sorted(seen["near_dedup"][0].items())
    assert kept("near_dedup") == {i for (i, _), (_, c) in zip(before, brute.components(before, 5, 80)) if i == c}
    assert kept("drop_contaminated") == {i for i, t in seen["drop_contaminated"][0].items() if not brute.contamination(t, items)[-1]}
    before, after = seen["redact_secrets"]
    assert set(after) == set(before) and after[304]["text"].endswith("[SECRET]")
    assert all(after[i]["text"] == t for i, t in before.items() if i != 304)
    assert kept("tokenize") == set(before)
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(before)


def test_rows_are_judged_each_by_its_own_text(spark, folder):
    """Clean rows with a null or repeated doc_id shield no other row of that id."""
    sf_dir, docs, items = folder
    rng = random.Random(10)
    fresh = lambda: " ".join(rng.choice("bcdfghjklm") + rng.choice(["ati", "ona", "eru"]) + rng.choice("nprst") for _ in range(60))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = lambda rows: spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)], schema).repartition(3)
    seen = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)

    clean = docs[1][1]
    toxic = [(None, docs[0][1] + " grobnik"), (1, docs[5][1])]
    train = [d for d in docs[:200] if d[0] != 1]
    got = seen(corpus_pipeline.drop_toxic(spark, table([*train, (None, clean), (1, clean), *toxic]), sf_dir))
    assert got == sorted([d for d in train if "grobnik" not in d[1]] + [(None, clean), (1, clean)], key=repr)

    held = [(None, f"{fresh()} {items[0][1]}"), (5, f"{fresh()} {items[0][1]} end")]
    fine = [(None, fresh()), (5, fresh()), (None, None)]
    assert seen(corpus_pipeline.drop_contaminated(spark, table(fine + held), sf_dir)) == sorted(fine, key=repr)

    a, b, c, d, e = (fresh() for _ in range(5))
    rows = [(None, a), (None, a), (None, a + " more"), (None, b), (4, b), (7, c), (7, c), (7, c + " more"), (7, d), (8, d), (None, e), (None, None), (9, ""), (9, "")]
    left = seen(corpus_pipeline.near_dedup(spark, table(rows), sf_dir))
    assert [r for r in left if not r[1]] == sorted([(None, None), (9, ""), (9, "")], key=repr)
    assert sorted((r[0], r[1].removesuffix(" more")) for r in left if r[0] is not None and r[1]) == sorted([(4, b), (7, c), (7, d)])
    assert sorted(r[1].removesuffix(" more") for r in left if r[0] is None and r[1]) == sorted([a, e])


def test_empty_tables(spark, folder, tmp_path):
    """Without documents nothing comes out; without labels and benchmark nothing is rejected for them."""
    pytest.importorskip("public_tokenizers")
    sf_dir, _, _ = folder
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    bare = str(tmp_path / "bare")
    spark.createDataFrame([], schema).write.parquet(f"{bare}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{bare}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{bare}/benchmark.parquet")
    assert corpus_pipeline.run(spark, bare).count() == 0
    docs = spark.createDataFrame([(1, "some clean words", "en", "s", 1), (None, None, None, None, None)], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert sorted(stage(spark, docs, bare).collect(), key=repr) == sorted(docs.collect(), key=repr), name
