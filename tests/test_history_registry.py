from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from eraloom.functions.scalars import to_bool
from eraloom.operators import history, registry, resume
from eraloom.plans import queries
from eraloom.sources import sinks, splits
from eraloom.streaming import history_stream

ROWS = "source string, model_name string, round_number int, fetched_at string, resolved boolean, primary_score double, ingest_seq long"


def scores(spark, rows):
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "round_number int, flag string, primary_score double, ingest_seq int")
    return df.select(F.lit("s").alias("source"), F.lit("m").alias("model_name"), "round_number", F.lit("t").alias("fetched_at"), to_bool(F.col("flag")).alias("resolved"), "primary_score")


@pytest.mark.parametrize(
    ("rows", "n", "sufficient"),
    [
        ([(1220, "false", None)], 0, False),
        ([(1225, "true", 0.030), (1224, "true", 0.022), (1223, "true", 0.018)], 3, True),
        ([(1225, "true", -0.030), (1224, "true", -0.010), (1223, "true", -0.015)], 3, False),
        ([(1225, "True", 0.020), (1224, "true", 0.015), (1223, "False", 0.050)], 2, True),
    ],
)
def test_evidence(spark, rows, n, sufficient):
    e = history.score_evidence(scores(spark, rows)).first()
    assert (e["n"], e["sufficient"]) == (n, sufficient)
    assert (e["evidence"] >= 65) == sufficient


def test_merge_is_idempotent_and_new_rows_win(spark):
    old = spark.createDataFrame([("s", "m", 1, "t", True, 0.1, 1)], ROWS)
    new = spark.createDataFrame([("s", "m", 1, "t", True, 0.2, 2), ("s", "m", 2, "t", True, 0.3, 3)], ROWS)
    merged = history.merge_history(old, new)
    assert sorted(r["primary_score"] for r in merged.collect()) == [0.2, 0.3]
    assert sorted(r["primary_score"] for r in history.merge_history(merged, new).collect()) == [0.2, 0.3]
    assert history.merge_history(old.limit(0), new.limit(0)).count() == 0


def test_normalize_nested_snapshot(spark):
    raw = '{"rounds":[{"tournamentRound":7.9,"corr_20":"0.5","mmc":0.25,"resolved":"yes","deep":[{"round":8,"payout":2,"source":"own"}]},{"roundNumber":9},{"roundNumber":"9.5","corr":1},{"Round":5,"round":6,"corr":true,"resolve":"2023-12-31T23:00:00-02:00"}]}'
    snap = spark.createDataFrame([("2024", "api", "m", raw)], "fetched_at string, source string, model_name string, j string").select("fetched_at", "source", "model_name", F.parse_json("j").alias("value"))
    rec = history.flatten_records(snap).select("fetched_at", "source", "model_name", history.as_map(F.col("record")).alias("record"))
    got = {r["round_number"]: r for r in history.normalize_records(rec, F.lit("2024-01-01").cast("timestamp")).collect()}
    assert sorted(got) == [6, 7, 8] and got[8]["source"] == "own" and got[7]["source"] == "api"
    assert got[6]["corr20"] == 1.0 and not got[6]["resolved"]  # one hour after the time asked for
    assert got[7]["resolved"] and abs(got[7]["primary_score"] - (0.75 * 0.5 + 2.25 * 0.25)) < 1e-12 and got[8]["payout"] == 2.0


def test_records_at_any_depth(spark):
    """More levels and rows than a recursive query would take."""
    deep = "[" * 110 + '{"round":1,"payout":1}' + "]" * 110
    wide = "[" + ",".join('{"round":2,"payout":1}' for _ in range(50)) + "]"
    snaps = spark.range(40).select(F.col("id").cast("string").alias("fetched_at"), F.lit("s").alias("source"), F.lit("m").alias("model_name"), F.parse_json(F.when(F.col("id") == 0, F.lit(deep[:0] + wide)).otherwise(F.lit(wide))).alias("value"))
    assert history.flatten_records(snaps).count() == 2000
    one = spark.range(1).select(F.parse_json(F.lit("[" * 5 + '{"a":{"b":[{}]}}' + "]" * 5)).alias("value"))
    assert history.flatten_records(one).count() == 3


def test_intra_round_last_bucket_wins(spark):
    b = lambda n, v, settled=None, date="2024-01-01": (n, v, date, "1.0", settled)
    rounds = [(3, [b("V2_CORR20 ", "0.1"), b("v2_corr20", "0.2"), b("bmc", "0.4", "5.0"), b("corr20", "9"), b("canon_fnc_v3", "0.3", date="")]), (4, []), (5, [b("corr", None, date=None), b("canon_corr", "1", date="2030-01-01")])]
    df = spark.createDataFrame([("t", "s", "m", rounds)], f"fetched_at string, source string, model_name string, rounds {history.INTRA_ROUND}")
    got = {r["round_number"]: r for r in history.intra_round_rows(df, F.lit("2024-01-02").cast("timestamp")).collect()}
    assert sorted(got) == [3, 5]
    r = got[3]
    assert (r["corr20"], r["bmc20"], r["fnc"], r["payout"], r["resolve_date"], r["resolved"]) == (0.2, 0.4, 0.3, 5.0, "2024-01-01", True)
    assert (got[5]["corr20"], got[5]["payout"], got[5]["resolved"]) == (1.0, 2.0, False)


def test_intra_round_query_gathers_no_lists(spark, tmp_path):
    """Many events of one user and day stay rows; the last of a name wins."""
    events = [(k, 1 + k // 900, ["click", "view", "error"][k % 3], k / 8) for k in range(1000)]
    df = spark.createDataFrame(events, "event_id long, user_id long, event_type string, value double").select("*", F.lit("2024-01-05 10:00:00").cast("timestamp").alias("ts"))
    df.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    rows = queries.q38_intra_round(spark, str(tmp_path))
    assert "collect_list" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = {r["model_name"]: (r["round_number"], r["corr20"], r["bmc20"], r["payout"], r["resolved"]) for r in rows.collect()}
    last = lambda user, kind: max((k, round(v, 4)) for k, u, t, v in events if (u, t) == (user, kind))[1]
    paid = lambda user: 1.5 * sum(1 for k, u, _, _ in events if u == user and k % 4 == 0)
    assert got == {str(u): (5, last(u, "click"), last(u, "view"), paid(u), True) for u in (1, 2)}


def test_csv_round_trip(spark, tmp_path):
    rows = scores(spark, [(1, "true", 0.5)])
    sinks.write_history(rows, str(tmp_path / "h"), "csv")
    back = sinks.read_history(spark, str(tmp_path / "h"), "csv")
    assert back.columns == history.COLUMNS and back.first()["primary_score"] == 0.5


def test_registry(spark):
    full = {"created_at": "2024-01-01", "dataset_version": "v5", "feature_set": "all", "artifact_schema_version": 1, "features": ["f"], "transform": "rank_01", "blend_alpha": 0.5, "bench_neutralize_prop": 1.0, "bench_cols_used": ["b"]}
    rows = [
        full | {"artifact": "a1", "model": "x", "model_files": ["m1"], "features_by_model": {"m1": ["f"]}},
        full | {"artifact": "a2", "model": "x", "created_at": "2024-02-01", "model_files": ["m1", "m2"], "features_by_model": {"m1": ["f"], "m2": []}, "blend_alpha": 1.5},
        full | {"artifact": "a3", "model": "y", "dataset_version": None, "model_files": [], "features_by_model": {}, "transform": "other"},
    ]
    m = spark.createDataFrame(rows, registry.MANIFEST)
    files = spark.createDataFrame([("a1", "m1"), ("a2", "m1")], "artifact string, file string")
    v = registry.audit(m, files, "v5")
    assert sorted((r["artifact"], r["rule"]) for r in v.collect()) == [("a2", "missing_file"), ("a2", "out_of_range"), ("a2", "unmapped_model"), ("a3", "bad_transform"), ("a3", "missing_key"), ("a3", "no_models"), ("a3", "version_mismatch")]
    assert [tuple(r) for r in registry.promote(m, v).collect()] == [("x", "a1", "prod")]


@pytest.mark.parametrize("entries", [[None], ["m1", None], ["m1", ""], ["  "], [" m1 ", "\t"]])
def test_blank_model_files_block_promotion(spark, entries):
    full = {"artifact": "a", "model": "x", "created_at": "t", "dataset_version": "v5", "feature_set": "all", "artifact_schema_version": 1, "features": ["f"], "transform": "rank_01", "blend_alpha": 0.5, "bench_neutralize_prop": 1.0, "bench_cols_used": ["b"]}
    m = spark.createDataFrame([full | {"model_files": entries, "features_by_model": {"m1": ["f"]}}], registry.MANIFEST)
    v = registry.audit(m, spark.createDataFrame([("a", "m1")], "artifact string, file string"))
    assert {r["rule"] for r in v.collect()} == {"bad_model_file"} and registry.promote(m, v).count() == 0
    trimmed = m.withColumn("model_files", F.array(F.lit(" m1 ")))
    assert registry.audit(trimmed, spark.createDataFrame([("a", "m1")], "artifact string, file string")).count() == 0


def plain_payloads(payloads):
    """The order in which rows of a fetch replace each other, as a walk over plain objects."""
    rows = {}
    for name, payload in payloads:
        if not payload["ok"]:
            continue
        found = []
        if name == history.INTRA_METHOD and isinstance(payload["value"], list):
            for b in payload["value"]:
                if isinstance(b, dict) and isinstance(b.get("scores_"), list):
                    found.append((b["roundNumber"], {x["displayName"]: x["value"] for x in b["scores_"]}.get("corr")))

        def walk(node, found=found):
            if isinstance(node, dict):
                found.append((node.get("roundNumber"), node.get("corr")))
                for k in sorted(node):
                    walk(node[k], found)
            elif isinstance(node, list):
                for x in node:
                    walk(x, found)

        walk(payload["value"])
        for n, corr in found:
            if n is not None and corr is not None:
                rows[name, n] = corr
    return rows


def test_payloads_of_one_fetch(spark):
    """Failed methods count nowhere, rounds come before records, the last of a key stays; odd shapes are passed over."""
    bucket = lambda n, score, **more: {"roundNumber": n, "scores_": [{"displayName": "corr", "value": score}], **more}
    payloads = [
        ("daily", {"ok": True, "value": {"z": [{"roundNumber": 1, "corr": 0.1}, {"roundNumber": 1, "corr": 0.2}], "a": {"roundNumber": 1, "corr": 0.3, "in": [{"roundNumber": 2, "corr": 0.4}]}}}),
        ("weekly", {"ok": False, "value": [{"roundNumber": 1, "corr": 0.9}]}),
        (history.INTRA_METHOD, {"ok": True, "value": [bucket(1, 0.5), bucket(1, 0.6), bucket(2, 0.7, corr=0.8), bucket(3, 0.9), 5, [bucket(4, 1.0)], {"roundNumber": 6}, None]}),
        ("none", {"ok": True, "value": None}),
        ("text", {"ok": True, "value": "x"}),
    ]
    raw = [("t", "m", name, k, p["ok"], json.dumps(p["value"]).replace("scores_", "intraRoundSubmissionScores")) for k, (name, p) in enumerate(payloads)]
    df = spark.createDataFrame(raw, "fetched_at string, model_name string, source string, mpos int, ok boolean, j string").select("*", F.parse_json("j").alias("value"))
    got = {(r["source"], r["round_number"]): r["corr20"] for r in history.normalize_payloads(df, F.lit("2024-01-01").cast("timestamp")).collect()}
    expected = plain_payloads(payloads)
    assert got == expected and got["daily", 1] == 0.2 and got[history.INTRA_METHOD, 2] == 0.8 and (history.INTRA_METHOD, 4) not in got
    assert history.normalize_payloads(df.limit(0), F.lit("2024-01-01").cast("timestamp")).count() == 0


def test_columns_that_a_manifest_table_lacks_are_violations(spark):
    m = spark.createDataFrame([("a1", "x", ["m1"])], "artifact string, model string, model_files array<string>")
    v = registry.audit(m, spark.createDataFrame([("a1", "m1")], "artifact string, file string"), "v5")
    assert sorted({r["rule"] for r in v.collect()}) == ["bad_transform", "missing_key", "no_benchmarks", "no_features", "out_of_range", "unmapped_model", "version_mismatch"]
    assert sorted(r["detail"] for r in v.where("rule = 'missing_key'").collect()) == ["artifact_schema_version", "dataset_version", "feature_set"]


def test_model_features_round_trip(spark, tmp_path):
    rows = [(f"m{k}.txt", p, f"f{k}_{p}") for k in range(3) for p in range(k + 1)]
    sinks.write_model_features(spark.createDataFrame(rows, "model_file string, pos int, feature string"), str(tmp_path / "map"))
    assert sorted(map(tuple, splits.model_features(spark, str(tmp_path / "map")).collect())) == rows


def test_prepared_split_follows_the_files(spark, tmp_path):
    import os

    path = str(tmp_path / "train")
    spark.range(40).selectExpr("id AS feature_0", "'era1' AS era", "concat('r', id) AS id", "1D AS target").repartition(4).write.parquet(path)
    assert splits.prepared_split(spark, path, ["feature_0"]).count() == 40
    parts = [f for f in os.listdir(path) if f.endswith(".parquet")]
    os.remove(f"{path}/{parts[0]}")
    spark.catalog.refreshByPath(path)
    assert splits.prepared_split(spark, path, ["feature_0"]).count() == spark.read.parquet(path).count() < 40


def test_sources_round_trip(spark, tmp_path):
    live = spark.createDataFrame([("a", 1, 0.5), ("b", 2, 0.25)], "__index_level_0__ string, era int, feature_0 double")
    live.write.parquet(str(tmp_path / "live"))
    assert splits.read_live(spark, str(tmp_path / "live"), ["feature_0"]).columns == ["id", "era", "feature_0"]
    with pytest.raises(Exception, match="lacks"):
        splits.read_live(spark, str(tmp_path / "live"), ["feature_1"])
    assert splits.read_benchmarks(spark, str(tmp_path / "live"), ["feature_0"]).columns == ["id", "feature_0"]
    with pytest.raises(Exception, match="missing"):
        splits.read_benchmarks(spark, str(tmp_path / "live"), ["other"])
    (tmp_path / "features.json").write_text('{"feature_sets": {"small": ["f2", "f1"], "all": ["f1"]}}')
    assert [tuple(r) for r in splits.feature_catalog(spark, str(tmp_path / "features.json"), "small").orderBy("pos").collect()] == [("small", 0, "f2"), ("small", 1, "f1")]
    with pytest.raises(ValueError, match="unknown"):
        splits.feature_catalog(spark, str(tmp_path / "features.json"), "none")
    sinks.write_submission(live.selectExpr("__index_level_0__ AS id", "feature_0 AS prediction", "era"), str(tmp_path / "sub"))
    assert spark.read.option("header", True).csv(str(tmp_path / "sub")).columns == ["id", "prediction"]
    oof = live.selectExpr("era AS window_id", "feature_0 AS prediction")
    sinks.write_oof(oof, str(tmp_path / "oof"))
    sinks.write_oof(oof.where("window_id = 2").selectExpr("window_id", "prediction * 2 AS prediction"), str(tmp_path / "oof"))
    assert sorted((r["window_id"], r["prediction"]) for r in sinks.read_oof(spark, str(tmp_path / "oof")).collect()) == [(1, 0.5), (2, 0.5)]
    assert sinks.read_oof(spark, str(tmp_path / "oof"), [1]).count() == 1
    snaps = spark.createDataFrame([("2024-01-01T05:00:00Z", "x")], "fetched_at string, raw string")
    sinks.write_snapshot(snaps, str(tmp_path / "raw"))
    sinks.write_snapshot(snaps, str(tmp_path / "raw"))
    assert spark.read.json(str(tmp_path / "raw")).where("fetch_date = '2024-01-01'").count() == 2
    sinks.write_report(oof, str(tmp_path), "report")
    assert spark.read.parquet(str(tmp_path / "report")).count() == 2


def test_resume(spark):
    wanted = spark.createDataFrame([(1,), (2,)], "k int")
    done = spark.createDataFrame([(1, "s"), (2, "old")], "k int, signature string")
    assert [r["k"] for r in resume.pending(wanted, resume.reusable(done, "s"), ["k"]).collect()] == [2]
    assert resume.pending(wanted, resume.reusable(done, "s", "fresh"), ["k"]).count() == 2
    with pytest.raises(ValueError, match="signature"):
        resume.reusable(done, "s", "strict")
    rows = spark.createDataFrame([("1", "m.txt", "5"), ("x", "n.txt", "5")], "seed string, model_file string, best_iteration string")
    assert [r["seed"] for r in resume.normalize_members(rows).collect()] == [1]


def test_split_reader(spark, tmp_path):
    path = str(tmp_path / "train.parquet")
    spark.range(20).selectExpr("id AS feature_0", "id + 200 AS feature_1", "concat('era', id div 4 + 1) AS era", "concat('row_', id) AS id", "CASE WHEN id IN (2, 7) THEN NULL ELSE id / 20D END AS target").write.parquet(path)
    plain = splits.read_split(spark, path, ["feature_0", "feature_1"])
    small = splits.read_split(spark, path, ["feature_0", "feature_1"], use_int8=True)
    assert plain.count() == small.count() == 18
    assert dict(plain.dtypes)["feature_0"] == "bigint" and dict(small.dtypes)["feature_0"] == "tinyint"
    assert small.where("feature_1 IS NOT NULL").count() == 0
    assert splits.feature_dtype(plain) == "int8"
    assert splits.prepared_split(spark, path, ["feature_0"]).count() == splits.prepared_split(spark, path, ["feature_0"]).count() == 18


def test_stream_accepts_late_files(spark, tmp_path):
    a = spark.createDataFrame([("s", "m", 1, "t", True, 0.1, 1)], ROWS)
    b = spark.createDataFrame([("s", "m", 1, "t", True, 0.2, 2), ("s", "m", 2, "t", True, 0.3, 3)], ROWS)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    a.union(b).repartition(3).write.parquet(source)
    history_stream.ingest(spark, source, ROWS, target, lambda df: df).awaitTermination()
    got = history_stream.latest_version(spark, target)
    assert sorted((r["round_number"], r["primary_score"]) for r in got.collect()) == [(1, 0.2), (2, 0.3)]


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    files = [[("s", "m", 1, "t", True, 0.1, 1), ("s", "m", None, "t", True, 0.5, 2)], [("s", "m", 1, "t", True, 0.2, 3), ("s", "n", 2, "t", True, 0.3, 4)], [("s", "m", 2, "t", True, 0.4, 5), ("s", "n", None, "t", True, 0.6, 6)]]
    state = {}
    for rows in files:
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(source)
        history_stream.ingest(spark, source, ROWS, target, lambda df: df, fan=2).awaitTermination()
        state |= {(r[1], r[2]): r[5] for r in rows}
        got = {(r["model_name"], r["round_number"]): r["primary_score"] for r in history_stream.latest_version(spark, target).collect()}
        assert got == state
    assert history_stream.segments(spark, target) == [(0, 0), (0, 1), (1, 1), (2, 2)]


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 3, 1)])
def test_stream_equals_batch_in_any_order(spark, tmp_path, order):
    """A late file never beats a larger ordinal; merges in between change nothing."""
    rows = [[("s", "m", k % 3, "t", True, f * 0.1 + k, 10 * ((f * 7 + k * 3) % 5) + f) for k in range(4)] for f in range(4)]
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for f in order:
        spark.createDataFrame(rows[f], ROWS).coalesce(1).write.mode("append").parquet(source)
    history_stream.ingest(spark, source, ROWS, target, lambda df: df, fan=2, files_per_batch=1).awaitTermination()
    assert (0, 3) in history_stream.segments(spark, target)
    everything = spark.createDataFrame([r for f in rows for r in f], ROWS)
    seen = lambda df: sorted(map(tuple, df.select("model_name", "round_number", "primary_score", "ingest_seq").collect()))
    assert seen(history_stream.latest_version(spark, target)) == seen(history.keep_last(everything, "ingest_seq"))
    one, other = (spark.createDataFrame([r for f in part for r in rows[f]], ROWS) for part in (order[:2], order[2:]))
    assert seen(history.merge_history(one, other)) == seen(history.keep_last(everything, "ingest_seq"))


def test_merges_read_each_row_a_few_times():
    """Over 4,096 batches a batch reads nothing on most days, and each is rewritten once for each tier."""
    spans, read = [], 0
    for b in range(4096):
        spans.append((b, b))
        if span := history_stream.merge_span(b, 16):
            parts = history_stream.cover(sorted(spans), *span)
            assert parts[0][0] == span[0] and parts[-1][1] == b and all(x[1] + 1 == y[0] for x, y in zip(parts, parts[1:], strict=False))
            read += sum(high - low + 1 for low, high in parts)
            spans = [s for s in spans if not span[0] <= s[0]] + [span]
        assert len(history_stream.cover(sorted(spans))) <= 3 * 15
    assert read <= 3 * 4096


def test_segments_of_broken_writes_do_not_count(spark, tmp_path):
    target = str(tmp_path / "out")
    row = lambda score, seq: spark.createDataFrame([("s", "m", 1, "t", True, score, seq)], ROWS)
    row(0.1, 1).write.parquet(f"{target}/segment-0-0")
    row(0.2, 2).write.parquet(f"{target}/segment-1-1")
    row(9.9, 9).write.parquet(f"{target}/segment-0-1")
    (tmp_path / "out" / "segment-0-1" / "_SUCCESS").unlink()
    assert [r["primary_score"] for r in history_stream.latest_version(spark, target).collect()] == [0.2]


def test_records_are_read_once_whatever_names_their_fields(spark):
    """A filter on the fields used to repeat the whole reading of the record for each mention: 260 times."""
    snap = spark.createDataFrame([("t", "api", "m", '{"Corr":1,"corr":"2.5","round":3,"in":[{"round":"x"}]}')], "fetched_at string, source string, model_name string, j string").select("fetched_at", "source", "model_name", F.parse_json("j").alias("value"))
    rec = history.flatten_records(snap).select("fetched_at", "source", "model_name", history.as_map(F.col("record")).alias("record"))
    out = history.normalize_records(rec, F.lit("2024-01-01").cast("timestamp"))
    assert [(r["round_number"], r["corr20"]) for r in out.collect()] == [(3, 2.5)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("map_from_entries") <= len(plan.split("Relation [")) - 1
