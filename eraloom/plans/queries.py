"""Registered queries over the driver's tables, with their DuckDB counterparts.

Adapters give the star-schema tables the shapes the operators expect: orders are
rows with an era (month), a prediction and a target; line items grouped by order
are benchmarks; embeddings are features; events are score history.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eraloom.functions import ranks, scalars
from eraloom.operators import align, blend, gates, history, metrics, modelling, neutralize, registry, resume, trees, walkforward
from eraloom.plans.scratch import materialize, scratch_path
from eraloom.sources import sinks, splits
from eraloom.streaming import history_stream

BENCHES = ["bench_qty", "bench_disc"]
CHUNK, PURGE = 12, 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    month = (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")
    out = o.select(F.col("o_orderkey").cast("string").alias("id"), month.alias("m"), F.col("o_totalprice").alias("prediction"), ((F.col("o_custkey") % 5) / 4.0).alias("target"))
    return out.select("id", F.concat(F.lit("era"), F.lpad(F.col("m").cast("string"), 4, "0")).alias("era"), F.col("m").alias("era_int"), "prediction", "target")


def benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("id"))
    return items.agg(F.sum("l_quantity").alias("bench_qty"), F.round(F.avg("l_discount"), 6).alias("bench_disc"))


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.join_benchmarks(rows(spark, sf_dir), benchmarks(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str, n: int = 64) -> DataFrame:
    e = _table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("string").alias("id"), (F.floor(F.col("vec_id") / 25) + 1).cast("int").alias("era_int"), F.col("label").cast("double").alias("target"), *(F.col("embedding")[k].cast("double").alias(f"feature_{k}") for k in range(n)))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:00:00'Z'").alias("fetched_at"),
        F.col("event_type").alias("source"),
        F.col("user_id").cast("string").alias("model_name"),
        F.dayofyear("ts").alias("round_number"),
        (F.col("event_type") != "error").alias("resolved"),
        F.round(F.col("value") / 1000 - 0.05, 6).alias("primary_score"),
        F.col("event_id").alias("ingest_seq"),
    )


def r6(*columns: str) -> list:
    return [(F.round(F.col(c).cast("double"), 6) + F.lit(0.0)).alias(c) for c in columns]


# SQL building blocks -------------------------------------------------------

SQL_ROWS = """R AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, 'era' || lpad(CAST((year(o_orderdate)-1995)*12+month(o_orderdate) AS VARCHAR), 4, '0') AS era,
  CAST((year(o_orderdate)-1995)*12+month(o_orderdate) AS INTEGER) AS era_int, o_totalprice AS prediction, (o_custkey % 5)/4.0 AS target FROM orders)"""
SQL_BENCH = "B AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, sum(l_quantity) AS bench_qty, round(avg(l_discount), 6) AS bench_disc FROM lineitem GROUP BY 1)"
SQL_ALIGNED = """A AS (SELECT R.*, CASE WHEN B.id IS NOT NULL THEN CAST(CAST(bench_qty AS FLOAT) AS DOUBLE) ELSE 0 END AS bench_qty,
  CASE WHEN B.id IS NOT NULL THEN CAST(CAST(bench_disc AS FLOAT) AS DOUBLE) ELSE 0 END AS bench_disc, B.id IS NOT NULL AS bench_present FROM R LEFT JOIN B USING (id))"""
SQL_SCORES = """S AS (SELECT strftime(ts, '%Y-%m-%dT%H:00:00Z') AS fetched_at, event_type AS source, CAST(user_id AS VARCHAR) AS model_name, CAST(dayofyear(ts) AS INTEGER) AS round_number,
  event_type <> 'error' AS resolved, round(value / 1000 - 0.05, 6) AS primary_score, event_id AS ingest_seq FROM events)"""


def sql_ppf(p: str) -> str:
    """AS 241 as SQL text over an expression, from the same coefficients."""

    def ratio(table, x):
        def poly(part):
            text = repr(part[0])
            for k in part[1:]:
                text = f"({text}*{x}+{k!r})"
            return text

        return f"({poly(table[0])}/{poly(table[1])})"

    r = f"sqrt(-ln(CASE WHEN {p} <= 0.5 THEN {p} ELSE 1-{p} END))"
    outer = f"(CASE WHEN {r} <= 5 THEN {ratio(scalars._MIDDLE, f'({r}-1.6)')} ELSE {ratio(scalars._TAIL, f'({r}-5)')} END)"
    return f"(CASE WHEN abs({p}-0.5) <= 0.425 THEN ({p}-0.5)*{ratio(scalars._CENTRAL, f'(0.180625-({p}-0.5)*({p}-0.5))')} ELSE sign({p}-0.5)*{outer} END)"


def sql_share(x: str, by: str) -> str:
    """Rank share in (0, 1) with ties averaged."""
    return f"(((rank() OVER (PARTITION BY {by} ORDER BY {x}) + count(*) OVER (PARTITION BY {by} ORDER BY {x} RANGE UNBOUNDED PRECEDING))/2.0 - 0.5)/count(*) OVER (PARTITION BY {by}))"


def sql_gauss(source: str, by: str, xs: list[str], extra: str = "*") -> str:
    """A SELECT that adds g_<x> for each x."""
    inner = ", ".join(f"{sql_share(x, by)} AS u_{x}" for x in xs)
    return f"SELECT {extra}, {', '.join(f'{sql_ppf(f"u_{x}")} AS g_{x}' for x in xs)} FROM (SELECT *, {inner} FROM {source})"


def sql_power(x: str) -> str:
    return f"sign({x})*pow(abs({x}),1.5)"


SQL_MAPPING = "M AS (SELECT DISTINCT k, j, 'feature_' || j AS f FROM (SELECT unnest(range(len(embedding))) AS j FROM embeddings), range(5) r(k) WHERE (j + k) % 3 = 0)"
SQL_CORR = "coalesce(covar_pop(a,b)/nullif(stddev_pop(a)*stddev_pop(b),0),0)"


def sql_era_corr(source: str, by: str) -> str:
    """A SELECT of (by, corr) over a relation with prediction and target."""
    g = sql_gauss(f"(SELECT *, target - avg(target) OVER (PARTITION BY {by}) AS t FROM {source})", by, ["prediction"])
    return f"SELECT {by}, {SQL_CORR} AS corr FROM (SELECT {by}, {sql_power('g_prediction')} AS a, {sql_power('t')} AS b FROM ({g})) GROUP BY {by}"


def _sql_fit(source: str, y: str, by: str = "") -> str:
    """Two-regressor least squares by Cramer's rule with moments of the fit."""
    x1, x2 = "g_bench_qty", "g_bench_disc"
    m = f"SELECT {by + ',' if by else ''} avg({y}) my, var_pop({y}) vy, avg({x1}) m1, avg({x2}) m2, covar_pop({x1},{y}) c1, covar_pop({x2},{y}) c2, var_pop({x1}) v1, var_pop({x2}) v2, covar_pop({x1},{x2}) c12 FROM {source} {'GROUP BY ' + by if by else ''}"
    b = f"SELECT *, (c1*v2-c2*c12)/(v1*v2-c12*c12) b1, (c2*v1-c1*c12)/(v1*v2-c12*c12) b2 FROM ({m})"
    return f"SELECT *, my-b1*m1-b2*m2 b0, c1*b1+c2*b2 cf, b1*b1*v1+2*b1*b2*c12+b2*b2*v2 vf FROM ({b})"


SQL_RANKED = "G AS (" + sql_gauss("(SELECT *, target - avg(target) OVER (PARTITION BY era_int) AS t FROM A)", "era_int", ["prediction", *BENCHES]) + ")"
WITH_A = f"WITH {SQL_ROWS}, {SQL_BENCH}, {SQL_ALIGNED}"
SQL_RESID = "(g_prediction - {p}*(b0+b1*g_bench_qty+b2*g_bench_disc))/sqrt(vy-2*{p}*cf+{p}*{p}*vf)"
#: Half of all eras joined to one.
WITH_LARGE = f"WITH {SQL_ROWS}, {SQL_BENCH}, {SQL_ALIGNED.replace('A AS (', 'A0 AS (')}, A AS (SELECT * REPLACE (CASE WHEN era_int % 2 = 0 THEN 1000 ELSE era_int END AS era_int) FROM A0)"


def _sql_postprocess(alpha: str, prop: str) -> str:
    """Rank share of the blend, row by row."""
    blended = f"CAST({alpha}*g_prediction+(1-{alpha})*{SQL_RESID.format(p=prop)} AS FLOAT)"
    return f"{SQL_RANKED}, F AS ({_sql_fit('G', 'g_prediction')}), Z AS (SELECT id, era_int, {blended} AS s FROM G, F) SELECT id, era_int, round({sql_share('s', 'era_int')}, 6) AS submission FROM Z"


SQL_WINDOWS = f"""W AS (SELECT CAST(row_number() OVER (ORDER BY c) AS INTEGER) AS window_id, mn AS train_start, CAST((c-1)*{CHUNK}+1-{PURGE}-1 AS INTEGER) AS train_end, CAST((c-1)*{CHUNK}+1-{PURGE} AS INTEGER) AS purge_start,
  CAST((c-1)*{CHUNK} AS INTEGER) AS purge_end, CAST((c-1)*{CHUNK}+1 AS INTEGER) AS val_start, CAST(c*{CHUNK} AS INTEGER) AS val_end
  FROM (SELECT min(era_int) AS mn, max(era_int) AS mx FROM R) , generate_series(2, 1000) AS s(c)
  WHERE c <= mx // {CHUNK} AND mn <= (c-1)*{CHUNK}+1-{PURGE}-1 AND EXISTS (SELECT 1 FROM R WHERE era_int BETWEEN (c-1)*{CHUNK}+1 AND c*{CHUNK}))"""
SQL_OOF = f"OOF AS (SELECT A.*, window_id FROM A JOIN W ON era_int BETWEEN val_start AND val_end WHERE window_id > (SELECT max(window_id)-4 FROM W))"
SQL_OOF_LARGE = SQL_OOF.replace("SELECT A.*, window_id", "SELECT A.* REPLACE (CASE WHEN A.era_int % 4 <> 0 THEN window_id * 1000 ELSE A.era_int END AS era_int), window_id")
ALPHAS, PROPS = [0.0, 0.5, 1.0], [0.25, 0.5, 1.0]


# Queries -------------------------------------------------------------------


def q01_split_scan(spark, d):
    df = splits.read_split(spark, f"{d}/lineitem.parquet", ["l_quantity", "l_suppkey"], "l_orderkey", "l_shipdate", "l_discount", use_int8=True)
    return df.select("l_orderkey", "l_quantity", "l_suppkey", F.round(F.col("l_discount").cast("double"), 4).alias("target"))


def q02_era_parse(spark, d):
    r = rows(spark, d).select("id", "era", scalars.era_to_int(F.col("era")).alias("era_int"))
    return walkforward.train_rows(r, 40)


def q03_align_partial(spark, d):
    return aligned(spark, d).select("id", *r6(*BENCHES), "bench_present")


def q04_missing_ids(spark, d):
    missing = align.missing_ids(rows(spark, d), benchmarks(spark, d))
    return missing.orderBy("id").limit(align.SAMPLE).crossJoin(F.broadcast(missing.agg(F.count(F.lit(1)).alias("missing_count"))))


def q05_duplicate_keys(spark, d):
    return align.duplicate_keys(_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q06_null_ratio(spark, d):
    labels = _table(spark, d, "labels").select("doc_id", "quality", F.nullif("toxic", F.lit(0)).alias("toxic"))
    ids = _table(spark, d, "documents").select("doc_id")
    joined = align.join_benchmarks(ids, labels, "doc_id").where("bench_present")
    ratios = align.null_ratios(joined, ["quality", "toxic"])
    return ratios.select("column", *r6("null_ratio"), (F.col("null_ratio") <= 0).alias("kept"))


def q07_avg_tie_rank(spark, d):
    li = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")).alias("era_int"))
    return li.select("*", ranks.average_rank("l_quantity", ["era_int"]).alias("avg_rank"), ranks.group_size(["era_int"]).alias("n"))


def q07b_range_rank(spark, d):
    li = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")).alias("era_int"))
    return ranks.average_rank_by_range(li, "l_quantity", ["era_int"])


def q08_gauss_rank(spark, d):
    return rows(spark, d).select("id", "era_int", "prediction").transform(ranks.gauss_ranks, ["prediction"], ["era_int"]).withColumnRenamed("g_prediction", "gauss").select("id", "era_int", *r6("gauss"))


def q09_era_corr(spark, d):
    return metrics.era_corr(rows(spark, d), ["era_int"]).select("era_int", *r6("corr"))


def q10_mean_corr(spark, d):
    return metrics.mean_corr(rows(spark, d)).select(*r6("mean_corr"), "n_eras")


def q11_neutralize(spark, d):
    a = aligned(spark, d)
    ranked = ranks.gauss_ranks(a, ["prediction", *BENCHES], ["era_int"])
    return neutralize.neutralize(ranked, "g_prediction", ["g_bench_qty", "g_bench_disc"], 0.5).select("id", *r6("neutral"))


def q12_bmc(spark, d):
    return metrics.bmc(aligned(spark, d), BENCHES).select(*r6("bmc"), "n_eras")


def q13_postprocess(spark, d):
    config = neutralize.PostprocessConfig(0.5, 0.5, tuple(BENCHES))
    return neutralize.postprocess(aligned(spark, d), config).select("id", "era_int", *r6("submission"))


def one_large_era(spark, d) -> DataFrame:
    """The aligned rows with half of all eras joined to one."""
    return aligned(spark, d).withColumn("era_int", F.when(F.col("era_int") % 2 == 0, 1000).otherwise(F.col("era_int")))


def q43_large_era_corr(spark, d):
    return metrics.era_corr(one_large_era(spark, d), ["era_int"], by_range=True).select("era_int", *r6("corr"))


def q44_large_era_bmc(spark, d):
    return metrics.bmc(one_large_era(spark, d), BENCHES, by_range=True).select(*r6("bmc"), "n_eras")


def q45_large_era_postprocess(spark, d):
    config = neutralize.PostprocessConfig(0.3, 0.75, tuple(BENCHES))
    return neutralize.postprocess(one_large_era(spark, d), config, by_range=True).select("id", "era_int", *r6("submission"))


def q46_large_era_grid(spark, d):
    """The grid's windows, each with three quarters of its eras joined to one."""
    oof = _oof(spark, d).withColumn("era_int", F.when(F.col("era_int") % 4 != 0, F.col("window_id") * 1000).otherwise(F.col("era_int")))
    g = blend.summarize_grid(blend.score_grid(oof, BENCHES, blend.grid(spark, ALPHAS, PROPS), by_range=True))
    return g.select(F.col("alpha").cast("double").alias("alpha"), F.col("prop").cast("double").alias("prop"), *((F.round(F.col(c), 4) + F.lit(0.0)).alias(c) for c in ("hit_rate", "mean_score", "mean_corr", "mean_bmc")))


def q14_windows(spark, d):
    return walkforward.build_windows(rows(spark, d), CHUNK, PURGE)


def _oof(spark, d):
    a = aligned(spark, d)
    return walkforward.validation_rows(a, walkforward.last_windows(walkforward.build_windows(a, CHUNK, PURGE), 4), CHUNK)


def q15_window_coverage(spark, d):
    return walkforward.window_coverage(_oof(spark, d), 512, 8)


def q16_walkforward_summary(spark, d):
    report = walkforward.window_corr(_oof(spark, d)).withColumn("best_iter", F.col("window_id") * 100)
    return walkforward.summarize(report).select(*r6("mean_corr", "std_corr", "hit_rate", "sharpe"), "recommended_iters")


def _grid_scores(spark, d):
    return blend.score_grid(_oof(spark, d), BENCHES, blend.grid(spark, ALPHAS, PROPS))


def q17_blend_grid(spark, d):
    g = blend.summarize_grid(_grid_scores(spark, d))
    return g.select(F.col("alpha").cast("double").alias("alpha"), F.col("prop").cast("double").alias("prop"), *((F.round(F.col(c), 4) + F.lit(0.0)).alias(c) for c in ("hit_rate", "mean_score", "mean_corr", "mean_bmc")))


def q18_blend_best(spark, d):
    s = materialize(_grid_scores(spark, d), "grid-scores")
    best = blend.best_windows(s, blend.best_point(blend.summarize_grid(s)))
    return best.select("window_id", F.col("alpha").cast("double").alias("alpha"), F.col("prop").cast("double").alias("prop"), *((F.round(F.col(c), 4) + F.lit(0.0)).alias(c) for c in ("corr", "bmc", "score")), "hit")


def q19_exposure(spark, d):
    f = features(spark, d)
    return gates.exposures(f, [c for c in f.columns if c.startswith("feature_")], "target").select("feature", *r6("exposure"))


def q20_gates(spark, d):
    a = aligned(spark, d).select("id", *BENCHES, ranks.rank_01("prediction", ["era_int"]).alias("prediction"))
    return gates.gate_report(a, BENCHES, gates.GateLimits()).select("position", "gate", *r6("value", "bound"), "passed")


def q21_history_dedup(spark, d):
    return history.keep_last(scores(spark, d), "ingest_seq").select(*history.KEY, "primary_score", "ingest_seq")


def q22_latest_rounds(spark, d):
    merged = history.merge_history(scores(spark, d).where("ingest_seq % 2 = 0"), scores(spark, d))
    return history.latest_rounds(merged, 20).select("round_number", "fetched_at", "source", "model_name")


def q23_evidence(spark, d):
    e = history.score_evidence(history.keep_last(scores(spark, d), "ingest_seq"), by=["model_name"])
    return e.select("model_name", "n", F.round("mean_score", 9).alias("mean_score"), *r6("hit_rate"), "downside", *r6("std_score", "evidence"), "sufficient")


def q24_history_summary(spark, d):
    return history.summarize_history(scores(spark, d)).select("n_rows", "n_resolved", "min_round", "max_round", F.array_join("sources", ",").alias("sources"))


def q25_json_fields(spark, d):
    e = _table(spark, d, "events").select("event_id", F.try_parse_json("props").alias("value"))
    rec = history.flatten_records(e).select("event_id", history.as_map(F.col("record")).alias("m"))
    k = scalars.pick(F.col("m"), ["K", "missing"])
    return rec.select("event_id", scalars.json_whole(k).alias("k_int"), scalars.json_number(k).alias("k_double"), F.coalesce(scalars.json_number(k) != 0, F.lit(False)).alias("k_bool"))


def q26_pending_work(spark, d):
    w = walkforward.build_windows(rows(spark, d), CHUNK, PURGE)
    wanted = w.select("window_id").crossJoin(blend.grid(spark, ALPHAS, PROPS).select("grid_pos"))
    sig = resume.signature(F.lit(CHUNK).alias("chunk"), F.lit(PURGE).alias("purge"))
    done = wanted.where("(window_id + grid_pos) % 3 = 0").withColumn("signature", F.when(F.col("window_id") == 1, F.lit("old")).otherwise(sig))
    expected = spark.range(1).select(sig.alias("s")).first()["s"]
    return resume.pending(wanted, resume.reusable(done, expected), ["window_id", "grid_pos"])


def _artifacts(spark, d):
    o = _table(spark, d, "orders")
    file, names = F.concat(F.col("o_orderkey").cast("string"), F.lit("-1")), F.array(F.lit("f1"))
    m = o.select(
        F.col("o_orderkey").cast("string").alias("artifact"), (F.col("o_custkey") % 50).cast("string").alias("model"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string")).otherwise("v5").alias("dataset_version"), F.lit("all").alias("feature_set"), F.lit(1).alias("artifact_schema_version"),
        F.array(file).alias("model_files"), names.alias("features"), F.create_map(file, names).alias("features_by_model"), F.lit("rank_01").alias("transform"),
        F.lit(0.5).alias("blend_alpha"), F.lit(1.0).alias("bench_neutralize_prop"), F.array(F.lit("bench_qty")).alias("bench_cols_used"),
    )
    files = _table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("artifact"), F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("file"))
    return m, files


def q27_registry_audit(spark, d):
    return registry.audit(*_artifacts(spark, d))


def _faulty_artifacts(spark, d):
    """Manifests of which every twelfth kind breaks one rule, and the files that are there."""
    m, files = _artifacts(spark, d)
    case = F.col("artifact").cast("long") % 13
    at = lambda k, other, c: F.when(case == k, other).otherwise(F.col(c)).alias(c)
    null = F.lit(None)
    m = m.withColumn("dataset_version", F.lit("v5")).select(
        "artifact", "model", "created_at",
        F.when(case == 1, F.lit("v4")).when(case == 2, null).otherwise(F.col("dataset_version")).alias("dataset_version"), at(3, null, "feature_set"), at(4, null, "artifact_schema_version"),
        F.when(case == 5, F.array(null.cast("string"), F.get("model_files", F.lit(0)))).when(case == 6, F.array(F.concat(F.lit(" "), F.get("model_files", F.lit(0)), F.lit(" ")), F.lit("  "))).when(case == 7, F.array().cast("array<string>")).otherwise(F.col("model_files")).alias("model_files"),
        at(8, F.array().cast("array<string>"), "features"), at(9, F.create_map(F.lit("other"), F.array(F.lit("f1"))), "features_by_model"), at(10, F.lit("softmax"), "transform"),
        at(11, F.lit(1.5), "blend_alpha"), at(12, F.lit(-0.5), "bench_neutralize_prop"), at(0, null, "bench_cols_used"),
    )
    return m, files


def q50_registry_rules(spark, d):
    """Every rule of the audit, with the version as a warning, and whether the artifact may still be promoted."""
    m, files = _faulty_artifacts(spark, d)
    found = materialize(registry.audit(m, files, "v5", "warn"), "violations")
    sound = registry.promote(m.withColumn("model", F.col("artifact")), found).select("artifact", F.lit(True).alias("sound"))
    return found.join(sound, "artifact", "left").select("artifact", "severity", "rule", "detail", F.coalesce("sound", F.lit(False)).alias("sound"))


def q28_promote(spark, d):
    m, files = _artifacts(spark, d)
    return registry.promote(m, registry.audit(m, files))


def q29_feature_shards(spark, d):
    catalog = _table(spark, d, "embeddings").select(F.explode(F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda k: F.concat(F.lit("feature_"), k.cast("string")))).alias("feature")).distinct()
    return gates.feature_shards(catalog, [42, 1337, 2026], 24)


def q30_feature_neutralize(spark, d):
    out = neutralize.neutralize_per_era(features(spark, d, 1), "target", ["feature_0"], 0.5)
    return out.select("id", "era_int", *r6("neutral"))


def q48_era_fit(spark, d):
    """Two features inside each era, half of all eras joined to one, row by row."""
    return neutralize.neutralize_per_era(one_large_era(spark, d), "prediction", BENCHES, 0.5).select("id", "era_int", *r6("neutral"))


def q49_era_fit_of_all_features(spark, d):
    """What is left of the target after all 64 features: no product with any of them or with 1 remains, and the deviation is 1."""
    f = features(spark, d).withColumn("era_int", (F.col("id").cast("long") % 4).cast("int"))
    names = [c for c in f.columns if c.startswith("feature_")]
    out = neutralize.neutralize_per_era(f, "target", names, 1.0)
    products = out.groupBy("era_int").agg(F.avg("neutral").alias("one"), F.stddev_pop("neutral").alias("sd"), *(F.avg(F.col(c) * F.col("neutral")).alias(c) for c in names))
    tall = products.unpivot(["era_int", "sd"], ["one", *names], "feature", "product")
    return tall.select("era_int", "feature", *r6("product", "sd"))


def q31_member_summary(spark, d):
    s = scores(spark, d).groupBy("model_name").agg(F.count(F.lit(1)).alias("n"), F.max("primary_score").alias("c"), F.avg("primary_score").alias("r"))
    raw = s.select(F.col("model_name").alias("seed"), F.concat(F.lit("m"), "model_name").alias("model_file"), F.col("n").alias("best_iteration"), F.col("r").alias("best_valid_rmse"), F.when(F.col("n") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("c")).alias("best_valid_corr"))
    feats = _table(spark, d, "events").select(F.col("event_type").alias("feature"))
    m = resume.summarize_members(resume.normalize_members(raw), feats)
    return m.select(*r6("mean_best_iteration", "mean_rmse", "mean_corr", "max_corr"), "best_seed", "n_models", "n_features")


def q32_stream_history(spark, d):
    """Events as a stream of files in mixed order, so that late files bring smaller ordinals; about nine batches, merged by threes."""
    source = scratch_path(spark, "snapshots")
    for k in (7, 2, 5, 0, 8, 3, 6, 1, 4):
        scores(spark, d).where(F.col("ingest_seq") % 9 == k).write.mode("append").parquet(source)
    files = len(spark.read.parquet(source).inputFiles())
    target = scratch_path(spark, "history")
    schema = scores(spark, d).schema.simpleString()[len("struct<") : -1].replace(":", " ")
    history_stream.ingest(spark, source, schema, target, lambda df: df, fan=3, files_per_batch=-(-files // 9)).awaitTermination()
    return history_stream.latest_version(spark, target).select(*history.KEY, "primary_score", "ingest_seq")


def eras_of_fixed_number(spark, d, n: int = 40) -> DataFrame:
    """Embeddings as features in n eras whose size grows with the table; a tenth lacks benchmarks."""
    f = features(spark, d).withColumn("era_int", (F.col("id").cast("long") % n + 1).cast("int"))
    return f.withColumn("bench_present", F.col("id").cast("long") % 7 != 0)


def q33_gbt_walkforward(spark, d):
    f = materialize(eras_of_fixed_number(spark, d), "gbt-rows")
    params = modelling.Params(learning_rate=0.1, num_leaves=4, min_leaf=5, rounds=6, patience=3, scan_period=2, features=[f"feature_{k}" for k in range(64)])
    report, _ = modelling.walk_forward(f, walkforward.build_windows(f, 8, 1), params, 42)
    return report


class KnownTree:
    """Stands for a fitted tree (or model) whose prediction is a weighted sum of features."""

    def __init__(self, weights: dict[int, float]):
        self.weights = weights

    def values(self, x: np.ndarray) -> np.ndarray:
        return sum((x[:, k] * w for k, w in self.weights.items()), np.zeros(len(x)))


class KnownTrees:
    """Stands for a fitted ensemble; what is left for Spark is scanning and selection."""

    trees = [KnownTree({0: 1.0}), KnownTree({1: -1.0}), KnownTree({2: 1.0, 3: 0.5}), KnownTree({4: 2.0})]
    treeWeights = [1.0, 0.5, 0.25, 0.5]  # noqa: N815


def _known(train, valid, params, seed):
    return KnownTrees()


KNOWN = modelling.Params(rounds=4, patience=2, scan_period=2, features=[f"feature_{k}" for k in range(64)])


def q40_walkforward_selection(spark, d):
    """Windows, staged predictions, error and correlation curves, stopping and choice, with known trees."""
    f = materialize(eras_of_fixed_number(spark, d), "gbt-rows")
    report, _ = modelling.walk_forward(f, walkforward.build_windows(f, 8, 1), KNOWN, 1, _known)
    return report.select("window_id", "best_iter", *r6("corr", "rmse"))


def q41_oof(spark, d):
    """Out-of-fold rows of windows with enough covered rows, at each window's best iteration."""
    f = materialize(eras_of_fixed_number(spark, d), "gbt-rows")
    f = f.where("era_int > 16 OR era_int % 3 = 0")  # the first window has too few eras
    out = modelling.collect_oof(f, walkforward.build_windows(f, 8, 1), KNOWN, 1, _known, min_rows=10, min_eras=4)
    return out.select("window_id", "id", (F.round(F.col("prediction").cast("double"), 5) + F.lit(0.0)).alias("prediction"))


def q42_score_ensemble(spark, d):
    """Two models, one with a feature list of its own and one with the union, and their mean."""
    f = features(spark, d)
    union = [f"feature_{k}" for k in range(64)]
    mapping = spark.createDataFrame([("a", 1, "feature_9"), ("a", 0, "feature_5")], "model_file string, pos int, feature string")
    lists = {r["model_file"]: r["features"] for r in modelling.features_of_models(spark.createDataFrame([("a",), ("b",)], "model_file string"), mapping, union).collect()}
    models = {"a": (KnownTree({0: 1.0, 1: -2.0}), lists["a"]), "b": (KnownTree({63: 4.0}), lists["b"])}
    return modelling.score_ensemble(f, models).select("id", (F.round(F.col("prediction").cast("double"), 5) + F.lit(0.0)).alias("prediction"))


BOOSTED = modelling.Params(learning_rate=0.5, num_leaves=2, min_leaf=1, rounds=6, patience=6, scan_period=3, feature_fraction=1.0, bagging_fraction=1.0, features=["a", "b", "c"])


def boosting_rows(spark, d) -> DataFrame:
    """Orders with three coarse features and a target that leans on them."""
    o = _table(spark, d, "orders")
    key, month = F.col("o_orderkey"), (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")
    a, b, c = F.col("o_custkey") % 4, month % 3, key % 5
    y = 0.3 * a + F.when(b == 1, 0.8).otherwise(0.0) - F.when(c > 2, 0.55).otherwise(0.0) + (key * 7919 % 101) / 101.0
    return o.select(month.alias("era_int"), a.cast("double").alias("a"), b.cast("double").alias("b"), c.cast("double").alias("c"), y.alias("target"))


def q47_boosted_errors(spark, d):
    """Validation errors of boosted trees, as the fit saw them and as one pass over the fitted trees gives them."""
    rows = materialize(boosting_rows(spark, d), "boosting-rows")
    train, valid = rows.where("era_int <= 50"), rows.where("era_int > 50")
    model = modelling.fit_boosted(train, valid, BOOSTED, 1)
    seen = spark.createDataFrame(model.errors, "iter int, seen double")
    return trees.staged_errors(valid, model, BOOSTED.features).join(seen, "iter").select("iter", *r6("rmse", "seen"))


def q34_ensemble(spark, d):
    r = rows(spark, d).select("id", F.col("prediction").alias("p1"), (F.col("prediction") * 2).alias("p2"), (F.col("target") * 4).alias("p3"))
    out = neutralize.ensemble_mean(r, ["p1", "p2", "p3"])
    return out.select("id", F.round(F.col("prediction").cast("double"), 0).alias("prediction"))


def q35_live_alignment(spark, d):
    b = benchmarks(spark, d)
    live = align.covered_rows(rows(spark, d), b)
    text = b.withColumn("bench_text", F.concat(F.lit("x"), "id"))
    return align.align_live(live, text, [*BENCHES, "bench_text"]).rows.select("id", *r6(*BENCHES), "bench_present")


def q36_benchmark_profile(spark, d):
    return splits.benchmark_profile(benchmarks(spark, d))


def q37_coverage_by_era(spark, d):
    return align.coverage(aligned(spark, d), ["era_int"]).select("era_int", *r6("coverage"), "n_rows")


AS_OF = "2024-01-20 00:00:00"


def q38_intra_round(spark, d):
    """Events as flat buckets: named values of each user and day in order of event_id.
    Some buckets lack their date; a round is resolved if its last present date has passed."""
    e = _table(spark, d, "events")
    kind = F.col("event_type")
    name = F.when(kind == "click", "V2_CORR20").when(kind == "view", "bmc").when(kind == "error", " Canon_BMC ").when(kind == "signup", "canon_fnc_v3").otherwise("bmc20")
    day = F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    bucket = F.struct(name.alias("displayName"), F.round("value", 4).cast("string").alias("value"), day.alias("date"), F.lit("0.5").alias("payoutPending"), F.when(F.col("event_id") % 4 == 0, F.lit("1.5")).alias("payoutSettled"))
    place = F.struct("event_id", bucket.alias("b"))
    flat = e.select(F.lit("2024-02-01").alias("fetched_at"), F.lit("intra").alias("source"), F.col("user_id").cast("string").alias("model_name"), F.dayofyear("ts").alias("round_number"), F.lit(0).alias("rpos"), place.alias("pos"), bucket.alias("b"))
    out = history.bucket_rows(flat, F.lit(AS_OF).cast("timestamp"))
    return out.select("model_name", "round_number", *r6("corr20", "bmc20", "fnc", "payout", "primary_score"), "resolve_date", "resolved")


def q39_nested_snapshots(spark, d):
    """Events as nested JSON snapshots of four shapes, flattened and normalized."""
    e = _table(spark, d, "events").repartition("event_id")  # parsing outweighs reading: every core takes part
    n, v = F.dayofyear("ts").cast("string"), F.round("value", 4).cast("string")
    day = F.date_format("ts", "yyyy-MM-dd")
    shape = F.col("event_id") % 4
    text = (
        F.when(shape == 0, F.concat(F.lit('{"rounds":[{"tournamentRound":'), n, F.lit(',"corr_20":" '), v, F.lit('","mmc":'), v, F.lit(',"isResolved":"Resolved"},7]}')))
        .when(shape == 1, F.concat(F.lit('{"a":{"b":[[{"ROUND":'), n, F.lit('.7,"corr":'), v, F.lit(',"bmc_20":'), v, F.lit(',"mmc":9,"date":"x","resolve":"'), day, F.lit('"}]]}}')))
        .when(shape == 2, F.concat(F.lit('{"source":"own","round_number":"'), n, F.lit('","nmr_payout":'), v, F.lit(',"at_risk":true,"resolved":null,"resolved_at":"'), day, F.lit('T00:00:00Z","in":{"round":"1.5","payout":1}}')))
        .otherwise(F.concat(F.lit('{"roundNumber":null,"round":'), n, F.lit(',"corr20":'), v, F.lit("}")))
    )
    snaps = e.select(F.lit("2024-02-01").alias("fetched_at"), F.lit("api").alias("source"), F.col("event_id").cast("string").alias("model_name"), F.parse_json(text).alias("value"))
    records = history.flatten_records(snaps).select("fetched_at", "source", "model_name", history.as_map(F.col("record")).alias("record"))
    out = history.normalize_records(records, F.lit(AS_OF).cast("timestamp"))
    return out.select("model_name", "source", "round_number", "resolved", *r6("corr20", "mmc20", "bmc20", "payout", "stake", "primary_score"), "resolve_date")


def q51_payloads(spark, d):
    """Events as fetched payloads of three methods, a fifth of them failed: rounds of named scores
    (a later bucket of a round wins, a bucket's own numbers win over its scores), nested records, records that name another source."""
    e = _table(spark, d, "events").repartition("event_id")
    n, v, day = F.dayofyear("ts").cast("string"), F.round("value", 4).cast("string"), F.date_format("ts", "yyyy-MM-dd")
    shape = F.col("event_id") % 3
    bucket = lambda items, more="": F.concat(F.lit('{"roundNumber":'), n, F.lit(',"intraRoundSubmissionScores":['), *items, F.lit("]"), F.lit(more), F.lit("}"))
    first = bucket([F.lit('{"displayName":"v2_corr20","value":'), v, F.lit(',"date":"2023-01-01","payoutPending":"0.5"},7')])
    second = [F.lit('{"displayName":" BMC","value":"0.25","payoutSettled":2},{"displayName":"V2_CORR20","value":"'), v, F.lit('","date":"'), day, F.lit('"}')]
    text = (
        F.when(shape == 0, F.concat(F.lit("["), first, F.lit(","), F.when(F.col("event_id") % 2 == 0, bucket(second, ',"corr":5')).otherwise(bucket(second)), F.lit(",8]")))
        .when(shape == 1, F.concat(F.lit('{"a":{"b":[{"round":'), n, F.lit(',"corr":1},{"round":'), n, F.lit(',"corr":'), v, F.lit("}]}}")))
        .otherwise(F.concat(F.lit('[{"round":'), n, F.lit(',"source":"own","payout":'), v, F.lit("},{}]")))
    )
    method = F.when(shape == 0, history.INTRA_METHOD).when(shape == 1, "daily_user_performances").otherwise("round_model_performances")
    payloads = e.select(F.lit("2024-02-01").alias("fetched_at"), F.col("event_id").cast("string").alias("model_name"), method.alias("source"), shape.cast("int").alias("mpos"), (F.col("event_id") % 5 != 0).alias("ok"), F.parse_json(text).alias("value"))
    out = history.normalize_payloads(payloads, F.lit(AS_OF).cast("timestamp"))
    return out.select("model_name", "source", "round_number", "resolved", *r6("corr20", "bmc20", "payout", "primary_score"), "resolve_date")


def _split_tables(spark, d) -> list[DataFrame]:
    """Train, validation and their benchmarks: some ids in both benchmark tables, some values missing."""
    r, b, n = rows(spark, d).select("id", "era_int"), benchmarks(spark, d), F.col("id").cast("long")
    b = b.withColumn("bench_disc", F.when(n % 11 != 0, F.col("bench_disc")))
    return [r.where("era_int <= 40"), r.where("era_int > 40"), b.where(n % 3 != 0), b.where((n % 3 == 0) | (n % 7 == 0))]


def q52_split_profile(spark, d):
    """Rows, coverage, missing and repeated ids and null shares of three splits, every table read once."""
    out = align.profile_splits(*_split_tables(spark, d))
    return out.select("split", "n_rows", "n_covered", "n_missing", *r6("coverage"), "n_repeated", *r6("null_ratio_bench_qty", "null_ratio_bench_disc"))


def q53_expanding_fits(spark, d):
    """A linear model for every window's training range, from one pass over the rows."""
    a = aligned(spark, d)
    fits = walkforward.expanding_fits(a, walkforward.build_windows(a, CHUNK, PURGE), "prediction", BENCHES)
    r3 = lambda c: F.round(c, 3) + F.lit(0.0)
    return fits.select("window_id", "n", r3(F.col("intercept")).alias("intercept"), *(r3(F.get("beta", F.lit(k))).alias(c) for k, c in enumerate(BENCHES)))


def q54_round_trips(spark, d):
    """Every writer read back by its reader: (sink, n, total) of what came back."""
    at = lambda name: scratch_path(spark, name)
    a, b = materialize(aligned(spark, d), "round-trip"), benchmarks(spark, d)
    found = []

    def back(sink: str, df: DataFrame, total) -> None:
        found.append(df.agg(F.lit(sink).alias("sink"), F.count(F.lit(1)).alias("n"), F.round(F.sum(total.cast("double")), 3).alias("total")))

    path = at("split")
    a.withColumn("target", F.when(F.col("era_int") % 5 != 0, F.col("target"))).write.parquet(path)
    back("split", splits.read_split(spark, path, ["bench_qty"], era_col="era_int"), F.col("bench_qty") + F.col("target"))
    gates.require_columns(splits.prepared_split(spark, path, ["bench_qty"], era_col="era_int"), ["id", "bench_qty"], "the prepared split")
    back("prepared", splits.prepared_split(spark, path, ["bench_qty"], era_col="era_int"), F.col("bench_qty"))
    back("live", splits.read_live(spark, path, ["bench_disc"], "era_int"), F.round("bench_disc", 6))
    path = at("benchmarks")
    b.withColumnRenamed("id", "__index_level_0__").write.parquet(path)
    back("benchmarks", splits.read_benchmarks(spark, path, ["bench_qty"]), F.col("bench_qty") + F.length("id"))
    path = at("submission")
    sinks.write_submission(a, path)
    back("submission", spark.read.option("header", True).schema("id string, prediction double").csv(path), F.col("prediction") + F.length("id"))
    h = scores(spark, d).select("*", F.to_date("fetched_at").cast("string").alias("resolve_date"))
    path = at("snapshot")
    sinks.write_snapshot(h.select("fetched_at", "source", "primary_score"), path)
    back("snapshot", spark.read.schema("fetched_at string, source string, primary_score double, fetch_date string").json(path), F.col("primary_score") + F.substring("fetch_date", 9, 2).cast("int"))
    for fmt in ("parquet", "csv"):
        path = at(f"history-{fmt}")
        sinks.write_history(h, path, fmt)
        back(f"history {fmt}", sinks.read_history(spark, path, fmt), F.col("primary_score") + F.col("round_number") + F.col("resolved").cast("int"))
    path = at("oof")
    sinks.write_oof(_oof(spark, d).select("window_id", "id", "prediction"), path)
    back("oof", sinks.read_oof(spark, path), F.col("prediction") + F.col("window_id"))
    back("oof of two", sinks.read_oof(spark, path, [3, 4]), F.col("prediction"))
    folder = at("reports")
    sinks.write_report(align.coverage(a, ["era_int"]), folder, "coverage")
    back("report", spark.read.parquet(f"{folder}/coverage"), F.col("n_rows") + F.col("era_int"))
    mapping, path = _feature_mapping(spark, d), at("features")
    sinks.write_model_features(mapping.withColumnRenamed("features_key", "model_file"), path)
    back("model features", splits.model_features(spark, path), F.col("pos") + F.length("model_file"))
    path = at("catalog")
    sets = mapping.groupBy("features_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "feature"))), lambda x: x["feature"]).alias("list"))
    catalog = sets.agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("features_key", "list"))).alias("feature_sets"))).alias("value"))
    catalog.write.text(path)
    back("catalog", splits.feature_catalog(spark, path, "m1"), F.col("pos") + F.length("feature"))
    return reduce(DataFrame.union, found)


def q55_row_sample(spark, d):
    """A seeded sample of 2,000 rows, which is the operator's purpose."""
    return gates.sample_rows(rows(spark, d), 2_000, 7).select("id", "era_int")


def _feature_mapping(spark, d) -> DataFrame:
    """Feature lists of five models over the embedding's positions."""
    e = _table(spark, d, "embeddings")
    j = e.select(F.explode(F.sequence(F.lit(0), F.size("embedding") - 1)).alias("j")).distinct()
    each = j.crossJoin(F.broadcast(spark.range(5).withColumnRenamed("id", "k"))).where((F.col("j") + F.col("k")) % 3 == 0)  # five models
    return each.select(F.concat(F.lit("m"), "k").alias("features_key"), F.col("j").cast("int").alias("pos"), F.concat(F.lit("feature_"), "j").alias("feature"))


def q56_member_features(spark, d):
    """Members against the lists they name: right, wrong hash, wrong number, no list, and nothing asked."""
    mapping = _feature_mapping(spark, d)
    lists = resume.feature_lists(mapping)
    k = F.substring("features_key", 2, 1).cast("int")
    members = lists.select(
        k.alias("seed"), F.when(k == 2, "lost").otherwise(F.col("features_key")).alias("model_file"), F.lit(3).alias("best_iteration"), F.lit("").alias("features_key"),
        F.when(k == 1, F.lit("0" * 16)).when(k == 4, F.lit("")).otherwise(F.col("features_hash")).alias("features_hash"), F.when(k == 3, 7).otherwise(F.size("features")).alias("n_features_used"),
    )
    return resume.check_member_features(resume.normalize_members(members), mapping).select("seed", "model_file", "features_hash", "n_features_used", "problem")


def q57_feature_union(spark, d):
    return resume.feature_union(_feature_mapping(spark, d).where("features_key IN ('m0', 'm1', 'm3')"))


def q58_prediction_stats(spark, d):
    """Smallest, largest and deviation of ranked predictions, which the gates look at."""
    a = rows(spark, d).select("id", ranks.rank_01("prediction", ["era_int"]).alias("prediction"))
    return gates.prediction_stats(a).select(*r6("min", "max", "std"))


def q59_feature_choice(spark, d):
    catalog = _table(spark, d, "embeddings").select(F.explode(F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda k: F.concat(F.lit("feature_"), k.cast("string")))).alias("feature")).distinct()
    return gates.choose_features(catalog, 24, 1337)


def q60_scan_points(spark, d):
    """Iterations that a scan of every window would look at, had it as many rounds as eras to train on."""
    w = walkforward.build_windows(rows(spark, d), CHUNK, PURGE)
    return w.select("window_id", F.explode(scalars.scan_points(F.col("train_end"), 7)).alias("iter"))


def q61_sparse_columns(spark, d):
    """Checked alignment with partial coverage: a sparse column goes, the rest has no hole."""
    b = benchmarks(spark, d).withColumn("bench_sparse", F.when(F.col("id").cast("long") % 5 != 0, F.col("bench_qty")))
    found = align.align_benchmarks(rows(spark, d), b, allow_partial=True)
    return found.rows.select("id", *r6(*found.columns), "bench_present", F.lit(",".join(found.dropped)).alias("dropped"))


def q62_final_fit(spark, d):
    """Trees fitted on all rows with a fixed number of rounds, and their predictions row by row."""
    data = materialize(boosting_rows(spark, d), "boosting-rows")
    model = modelling.fit_final(data, BOOSTED, 4, 1)
    return trees.predict(data, model, BOOSTED.features, "prediction").groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 6).alias("prediction"))


#: Eras of fixed number, windows of 8 eras with one purged, and the sums of known trees.
SQL_KNOWN = """F AS (SELECT vec_id, CAST(vec_id % 40 + 1 AS INTEGER) AS era_int, vec_id % 7 <> 0 AS bench_present, label::DOUBLE AS target,
  embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b, embedding[3]::DOUBLE + 0.5*embedding[4]::DOUBLE AS c, 2*embedding[5]::DOUBLE AS d FROM embeddings),
 P AS (SELECT *, CAST((era_int - 1) // 8 AS INTEGER) AS window_id, a AS p1, a - 0.5*b AS p2, a - 0.5*b + 0.25*c AS p3, a - 0.5*b + 0.25*c + 0.5*d AS p4 FROM F WHERE era_int > 8),
 V AS (SELECT * FROM P WHERE {only}),
 L AS (SELECT window_id, era_int, target, i AS iter, CASE i WHEN 1 THEN p1 WHEN 2 THEN p2 WHEN 3 THEN p3 ELSE p4 END AS prediction FROM V, range(1, 5) r(i)),
 E AS (SELECT window_id, iter, sqrt(avg(pow(prediction - target, 2))) AS rmse FROM L GROUP BY 1, 2),
 R AS (SELECT window_id, max(rmse) FILTER (iter = 1) AS e1, max(rmse) FILTER (iter = 2) AS e2, max(rmse) FILTER (iter = 3) AS e3, max(rmse) FILTER (iter = 4) AS e4 FROM E GROUP BY 1),
 T AS (SELECT *, CASE WHEN e1 <= e2 AND e1 <= e3 THEN 3 ELSE 4 END AS stop FROM R),
 C AS (SELECT window_id, iter, avg(corr) AS corr FROM ({corr}) GROUP BY 1, 2),
 B AS (SELECT window_id, CAST(arg_max(iter, corr) AS INTEGER) AS best_iter, max(corr) AS corr, any_value(CASE WHEN stop = 3 THEN least(e1, e2, e3) ELSE least(e1, e2, e3, e4) END) AS rmse
   FROM C JOIN T USING (window_id) WHERE iter = stop OR iter = 2 GROUP BY 1)"""


def _sql_boosted(rounds: int = 6, rate: float = 0.5, train: str = "m <= 50", result: str = "") -> str:
    """Stumps round by round: of all cuts the one with the largest sum of squared side sums over side sizes."""
    steps = [
        "R0 AS MATERIALIZED (SELECT *, 0.0::DOUBLE AS f FROM (SELECT CAST((year(o_orderdate)-1995)*12+month(o_orderdate) AS INTEGER) AS m, o_custkey % 4 AS a, ((year(o_orderdate)-1995)*12+month(o_orderdate)) % 3 AS b, o_orderkey % 5 AS c, o_orderkey AS k,"
        " 0.3::DOUBLE*(o_custkey % 4) + CASE WHEN ((year(o_orderdate)-1995)*12+month(o_orderdate)) % 3 = 1 THEN 0.8::DOUBLE ELSE 0 END - CASE WHEN o_orderkey % 5 > 2 THEN 0.55::DOUBLE ELSE 0 END + (o_orderkey * 7919 % 101)/101.0::DOUBLE AS y FROM orders))",
        "S AS MATERIALIZED (SELECT 'a' AS n, t + 0.5 AS t FROM range(3) r(t) UNION ALL SELECT 'b', t + 0.5 FROM range(2) r(t) UNION ALL SELECT 'c', t + 0.5 FROM range(4) r(t))",
    ]
    x = "CASE n WHEN 'a' THEN a WHEN 'b' THEN b ELSE c END"
    for i in range(1, rounds + 1):
        label = "y" if i == 1 else "2*(y-f)"
        steps.append(f"C{i} AS MATERIALIZED (SELECT n, t, sum({label}) FILTER ({x} <= t) AS ls, count(*) FILTER ({x} <= t) AS ln, sum({label}) FILTER ({x} > t) AS rs, count(*) FILTER ({x} > t) AS rn FROM R{i - 1}, S WHERE {train} GROUP BY n, t)")
        steps.append(f"T{i} AS MATERIALIZED (SELECT * FROM C{i} ORDER BY ls*ls/ln + rs*rs/rn DESC LIMIT 1)")
        steps.append(f"R{i} AS MATERIALIZED (SELECT R{i - 1}.* REPLACE (f + {1.0 if i == 1 else rate} * CASE WHEN {x} <= t THEN ls/ln ELSE rs/rn END AS f) FROM R{i - 1}, T{i})")
    errors = " UNION ALL ".join(f"SELECT {i} AS iter, sqrt(avg(pow(f-y, 2))) AS rmse FROM R{i} WHERE m > 50" for i in range(1, rounds + 1))
    if result:
        return f"WITH {', '.join(steps)} {result}"
    return f"WITH {', '.join(steps)} SELECT CAST(iter AS INTEGER) AS iter, round(rmse, 6) AS rmse, round(rmse, 6) AS seen FROM ({errors})"


def _stats_sql(w_sql: str) -> str:
    return f"{WITH_A}, {SQL_WINDOWS}, {SQL_OOF} {w_sql}"


_GRID_SQL = (
    f"{WITH_A}, {SQL_WINDOWS}, {SQL_OOF}, G AS ("
    + sql_gauss("(SELECT *, target - avg(target) OVER (PARTITION BY window_id, era_int) AS t FROM OOF)", "window_id, era_int", ["prediction", *BENCHES], "window_id, era_int, target, t")
    + "), F AS ("
    + _sql_fit("G", "g_prediction", "window_id")
    + "), P AS (SELECT a.alpha, p.prop, a.k*3+p.k AS grid_pos FROM (VALUES (0.0::DOUBLE,0),(0.5,1),(1.0,2)) a(alpha,k), (VALUES (0.25::DOUBLE,0),(0.5,1),(1.0,2)) p(prop,k)),"
    + f" X AS (SELECT alpha, prop, grid_pos, window_id, era_int, target, t, g_prediction AS g, {SQL_RESID.format(p='prop')} AS resid FROM G JOIN F USING (window_id) CROSS JOIN P),"
    + " Y AS (SELECT grid_pos, window_id, era_int, target, resid*t AS rt, CAST(alpha*g+(1-alpha)*resid AS FLOAT) AS prediction FROM X),"
    + " C AS (SELECT grid_pos, window_id, avg(corr) AS corr FROM ("
    + sql_era_corr("Y", "grid_pos, window_id, era_int")
    + ") GROUP BY 1,2), M AS (SELECT grid_pos, window_id, avg(bmc) AS bmc FROM (SELECT grid_pos, window_id, era_int, avg(rt) AS bmc FROM Y GROUP BY 1,2,3) GROUP BY 1,2),"
    + " S AS (SELECT P.alpha, P.prop, grid_pos, window_id, corr, bmc, 0.75*corr+2.25*bmc AS score, 0.75*corr+2.25*bmc > 0 AS hit FROM C JOIN M USING (grid_pos, window_id) JOIN P USING (grid_pos)),"
    + " T AS (SELECT alpha, prop, grid_pos, avg(hit::INT) AS hit_rate, avg(score) AS mean_score, avg(corr) AS mean_corr, avg(bmc) AS mean_bmc FROM S GROUP BY 1,2,3)"
)
_ARTIFACT_SQL = """M AS (SELECT CAST(o_orderkey AS VARCHAR) AS artifact, CAST(o_custkey % 50 AS VARCHAR) AS model, strftime(o_orderdate, '%Y-%m-%d') AS created_at, o_orderstatus FROM orders),
V AS (SELECT artifact, 'error' AS severity, 'missing_key' AS rule, 'dataset_version' AS detail FROM M WHERE o_orderstatus = 'P'
 UNION ALL SELECT artifact, 'error', 'missing_file', artifact || '-1' FROM M WHERE artifact || '-1' NOT IN (SELECT l_orderkey || '-' || l_linenumber FROM lineitem))"""
_LATEST = "SELECT *, row_number() OVER (PARTITION BY {by} round_number ORDER BY fetched_at DESC, source, model_name) AS k FROM S WHERE resolved AND primary_score IS NOT NULL"

ORACLES: dict[str, str] = {
    "q01_split_scan": "SELECT l_orderkey, TRY_CAST(l_quantity AS TINYINT) AS l_quantity, TRY_CAST(l_suppkey AS TINYINT) AS l_suppkey, round(CAST(CAST(l_discount AS FLOAT) AS DOUBLE), 4) AS target FROM lineitem WHERE l_discount IS NOT NULL",
    "q02_era_parse": f"WITH {SQL_ROWS} SELECT id, era, CAST(regexp_extract(era, '(\\d+)', 1) AS INTEGER) AS era_int FROM R WHERE era_int <= 40",
    "q03_align_partial": f"{WITH_A} SELECT id, round(bench_qty, 6) AS bench_qty, round(bench_disc, 6) AS bench_disc, bench_present FROM A",
    "q04_missing_ids": f"WITH {SQL_ROWS}, X AS (SELECT id FROM R WHERE id NOT IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem)) SELECT id, (SELECT count(*) FROM X) AS missing_count FROM X ORDER BY id LIMIT 10",
    "q05_duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "q06_null_ratio": "WITH J AS (SELECT quality, nullif(toxic, 0) AS toxic FROM documents JOIN labels USING (doc_id)) SELECT 'quality' AS \"column\", round(avg((quality IS NULL)::INT), 6) AS null_ratio, avg((quality IS NULL)::INT) <= 0 AS kept FROM J UNION ALL SELECT 'toxic', round(avg((toxic IS NULL)::INT), 6), avg((toxic IS NULL)::INT) <= 0 FROM J",
    "q07_avg_tie_rank": "WITH L AS (SELECT l_orderkey, l_linenumber, l_quantity, CAST((year(l_shipdate)-1995)*12+month(l_shipdate) AS INTEGER) AS era_int FROM lineitem) SELECT *, (rank() OVER (PARTITION BY era_int ORDER BY l_quantity) + count(*) OVER (PARTITION BY era_int ORDER BY l_quantity RANGE UNBOUNDED PRECEDING))/2.0 AS avg_rank, count(*) OVER (PARTITION BY era_int) AS n FROM L",
    "q07b_range_rank": "WITH L AS (SELECT l_orderkey, l_linenumber, l_quantity, CAST((year(l_shipdate)-1995)*12+month(l_shipdate) AS INTEGER) AS era_int FROM lineitem) SELECT *, (rank() OVER (PARTITION BY era_int ORDER BY l_quantity) + count(*) OVER (PARTITION BY era_int ORDER BY l_quantity RANGE UNBOUNDED PRECEDING))/2.0 AS avg_rank FROM L",
    "q08_gauss_rank": f"WITH {SQL_ROWS} SELECT id, era_int, round(g_prediction, 6) + 0.0 AS gauss FROM ({sql_gauss('R', 'era_int', ['prediction'])})",
    "q09_era_corr": f"WITH {SQL_ROWS} SELECT era_int, round(corr, 6) + 0.0 AS corr FROM ({sql_era_corr('R', 'era_int')})",
    "q10_mean_corr": f"WITH {SQL_ROWS} SELECT round(avg(corr), 6) + 0.0 AS mean_corr, count(*) AS n_eras FROM ({sql_era_corr('R', 'era_int')})",
    "q11_neutralize": f"{WITH_A}, {SQL_RANKED}, F AS ({_sql_fit('G', 'g_prediction')}) SELECT id, round({SQL_RESID.format(p='0.5')}, 6) + 0.0 AS neutral FROM G, F",
    "q12_bmc": f"{WITH_A}, {SQL_RANKED}, F AS ({_sql_fit('G', 'g_prediction')}) SELECT round(avg(b), 6) + 0.0 AS bmc, count(*) AS n_eras FROM (SELECT era_int, avg({SQL_RESID.format(p='1.0')}*t) AS b FROM G, F GROUP BY 1)",
    "q13_postprocess": f"{WITH_A}, {_sql_postprocess('0.5', '0.5')}",
    "q43_large_era_corr": f"{WITH_LARGE} SELECT era_int, round(corr, 6) + 0.0 AS corr FROM ({sql_era_corr('A', 'era_int')})",
    "q44_large_era_bmc": f"{WITH_LARGE}, {SQL_RANKED}, F AS ({_sql_fit('G', 'g_prediction')}) SELECT round(avg(b), 6) + 0.0 AS bmc, count(*) AS n_eras FROM (SELECT era_int, avg({SQL_RESID.format(p='1.0')}*t) AS b FROM G, F GROUP BY 1)",
    "q45_large_era_postprocess": f"{WITH_LARGE}, {_sql_postprocess('0.3', '0.75')}",
    "q46_large_era_grid": f"{_GRID_SQL.replace(SQL_OOF, SQL_OOF_LARGE)} SELECT alpha, prop, round(hit_rate, 4) AS hit_rate, round(mean_score, 4) + 0.0 AS mean_score, round(mean_corr, 4) + 0.0 AS mean_corr, round(mean_bmc, 4) + 0.0 AS mean_bmc FROM T",
    "q14_windows": f"WITH {SQL_ROWS}, {SQL_WINDOWS} SELECT * FROM W",
    "q15_window_coverage": _stats_sql("SELECT window_id, covered_rows, covered_eras, CASE WHEN covered_rows < 512 THEN 'rows' WHEN covered_eras < 8 THEN 'eras' ELSE 'ok' END AS reason FROM (SELECT window_id, count(*) FILTER (bench_present) AS covered_rows, count(DISTINCT era_int) FILTER (bench_present) AS covered_eras FROM OOF GROUP BY 1)"),
    "q16_walkforward_summary": _stats_sql(f"SELECT round(avg(corr), 6) + 0.0 AS mean_corr, round(stddev_pop(corr), 6) AS std_corr, round(avg((corr > 0)::INT), 6) AS hit_rate, round(avg(corr)/stddev_pop(corr), 6) + 0.0 AS sharpe, CAST(trunc(median(window_id*100)) AS INTEGER) AS recommended_iters FROM (SELECT window_id, avg(corr) AS corr FROM ({sql_era_corr('OOF', 'window_id, era_int')}) GROUP BY 1)"),
    "q17_blend_grid": f"{_GRID_SQL} SELECT alpha, prop, round(hit_rate, 4) AS hit_rate, round(mean_score, 4) + 0.0 AS mean_score, round(mean_corr, 4) + 0.0 AS mean_corr, round(mean_bmc, 4) + 0.0 AS mean_bmc FROM T",
    "q18_blend_best": f"{_GRID_SQL}, Best AS (SELECT grid_pos FROM T ORDER BY hit_rate DESC, mean_score DESC, mean_corr DESC, grid_pos LIMIT 1) SELECT window_id, alpha, prop, round(corr, 4) + 0.0 AS corr, round(bmc, 4) + 0.0 AS bmc, round(score, 4) + 0.0 AS score, hit FROM S JOIN Best USING (grid_pos)",
    "q19_exposure": "SELECT 'feature_' || (k-1) AS feature, round(covar_pop(x, label)/(stddev_pop(x)*stddev_pop(label)), 6) + 0.0 AS exposure FROM (SELECT label::DOUBLE AS label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS k FROM embeddings) GROUP BY k",
    "q20_gates": f"{WITH_A}, U AS (SELECT bench_qty, bench_disc, {sql_share('prediction', 'era_int')} AS p FROM A), E AS (SELECT greatest(abs(corr(bench_qty, p)), abs(corr(bench_disc, p))) AS e, stddev_pop(p) AS s, max(abs(p)) AS m, count(*) FILTER (p < 1e-6::FLOAT OR p > (1-1e-6)::FLOAT)::DOUBLE AS o FROM U) SELECT 1 AS position, 'invalid_numbers' AS gate, 0.0::DOUBLE AS value, 0.0::DOUBLE AS bound, true AS passed FROM E UNION ALL SELECT 2, 'all_zero', round(m, 6), 0.0, m > 1e-8 FROM E UNION ALL SELECT 3, 'rank_bounds', o, 0.0, o = 0 FROM E UNION ALL SELECT 4, 'spread', round(s, 6), 1e-6, s >= 1e-6 FROM E UNION ALL SELECT 5, 'exposure', round(e, 6), 0.3, e <= 0.3 FROM E",
    "q21_history_dedup": f"WITH {SQL_SCORES} SELECT source, model_name, round_number, fetched_at, primary_score, ingest_seq FROM S QUALIFY row_number() OVER (PARTITION BY source, model_name, round_number, fetched_at ORDER BY ingest_seq DESC) = 1",
    "q22_latest_rounds": f"WITH {SQL_SCORES} SELECT round_number, fetched_at, source, model_name FROM ({_LATEST.format(by='')}) WHERE k = 1 ORDER BY round_number DESC LIMIT 20",
    "q23_evidence": f"WITH {SQL_SCORES.replace('FROM events)', 'FROM events QUALIFY row_number() OVER (PARTITION BY source, model_name, round_number, fetched_at ORDER BY event_id DESC) = 1)')}, L AS (SELECT * FROM ({_LATEST.format(by='model_name,')}) WHERE k = 1 QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY round_number DESC) <= 20), E AS (SELECT model_name, count(*) AS n, avg(primary_score) AS m, avg((primary_score > 0)::INT) AS h, count(*) FILTER (primary_score < 0) AS dn, stddev_pop(primary_score) AS sd FROM L GROUP BY 1), P AS (SELECT *, greatest(0.0, least(100.0, 50 + CASE WHEN n >= 2 THEN 20 ELSE 0 END + greatest(-15.0, least(15.0, m/0.02*15)) + greatest(-10.0, least(10.0, (h-0.5)/0.5*10)) - least(10.0, dn/greatest(n,1)*10) - CASE WHEN sd > 0.03 THEN 5 ELSE 0 END)) AS ev FROM E) SELECT model_name, n, round(m, 9) AS mean_score, round(h, 6) AS hit_rate, dn AS downside, round(sd, 6) AS std_score, round(ev, 6) AS evidence, n >= 2 AND ev >= 65 AS sufficient FROM P",
    "q24_history_summary": f"WITH {SQL_SCORES} SELECT count(*) AS n_rows, count(*) FILTER (resolved) AS n_resolved, min(round_number) AS min_round, max(round_number) AS max_round, (SELECT string_agg(source, ',' ORDER BY source) FROM (SELECT DISTINCT source FROM S)) AS sources FROM S",
    "q25_json_fields": "SELECT event_id, TRY_CAST(props->>'$.k' AS INTEGER) AS k_int, TRY_CAST(props->>'$.k' AS DOUBLE) AS k_double, coalesce(TRY_CAST(props->>'$.k' AS DOUBLE) <> 0, false) AS k_bool FROM events",
    "q26_pending_work": f"WITH {SQL_ROWS}, {SQL_WINDOWS} SELECT window_id, CAST(g AS INTEGER) AS grid_pos FROM W, generate_series(0, 8) AS s(g) WHERE NOT ((window_id + g) % 3 = 0 AND window_id <> 1)",
    "q27_registry_audit": f"WITH {_ARTIFACT_SQL} SELECT * FROM V",
    "q50_registry_rules": """WITH M AS (SELECT CAST(o_orderkey AS VARCHAR) AS artifact, o_orderkey % 13 AS k, o_orderkey || '-1' AS f, o_orderkey || '-1' IN (SELECT l_orderkey || '-' || l_linenumber FROM lineitem) AS there FROM orders),
      V AS (SELECT artifact, 'warn' AS severity, 'version_mismatch' AS rule, CASE k WHEN 1 THEN 'v4' ELSE 'none' END AS detail FROM M WHERE k IN (1, 2)
      UNION ALL SELECT artifact, 'error', 'missing_key', CASE k WHEN 2 THEN 'dataset_version' WHEN 3 THEN 'feature_set' ELSE 'artifact_schema_version' END FROM M WHERE k IN (2, 3, 4)
      UNION ALL SELECT artifact, 'error', 'bad_model_file', CASE k WHEN 5 THEN 'model_files:0' ELSE 'model_files:1' END FROM M WHERE k IN (5, 6)
      UNION ALL SELECT artifact, 'error', 'no_models', 'model_files' FROM M WHERE k = 7
      UNION ALL SELECT artifact, 'error', 'missing_file', f FROM M WHERE k <> 7 AND NOT there
      UNION ALL SELECT artifact, 'error', 'no_features', 'features' FROM M WHERE k = 8
      UNION ALL SELECT artifact, 'error', 'unmapped_model', f FROM M WHERE k = 9
      UNION ALL SELECT artifact, 'error', 'bad_transform', 'softmax' FROM M WHERE k = 10
      UNION ALL SELECT artifact, 'error', 'out_of_range', CASE k WHEN 11 THEN 'blend_alpha=1.5' ELSE 'bench_neutralize_prop=-0.5' END FROM M WHERE k IN (11, 12)
      UNION ALL SELECT artifact, 'error', 'no_benchmarks', 'bench_cols_used' FROM M WHERE k = 0)
      SELECT *, artifact NOT IN (SELECT artifact FROM V WHERE severity = 'error') AS sound FROM V""",
    "q51_payloads": """WITH E AS (SELECT event_id, CAST(event_id AS VARCHAR) AS model_name, event_id % 3 AS k, CAST(dayofyear(ts) AS INTEGER) AS n, round(value, 4) AS v, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE event_id % 5 <> 0)
      SELECT model_name, CASE k WHEN 0 THEN 'intra_round_scores' WHEN 1 THEN 'daily_user_performances' ELSE 'own' END AS source, n AS round_number,
        k = 0 AND event_id % 2 <> 0 AND CAST(day AS DATE) <= DATE '2024-01-20' AS resolved, CASE WHEN k = 0 AND event_id % 2 = 0 THEN 5.0::DOUBLE WHEN k < 2 THEN v END AS corr20,
        CASE WHEN k = 0 AND event_id % 2 <> 0 THEN 0.25::DOUBLE END AS bmc20, CASE WHEN k = 0 AND event_id % 2 <> 0 THEN 2.0::DOUBLE WHEN k = 2 THEN v END AS payout,
        CASE WHEN k = 0 AND event_id % 2 <> 0 THEN round(0.75*v + 2.25*0.25::DOUBLE, 6) END AS primary_score, CASE WHEN k = 0 AND event_id % 2 <> 0 THEN day END AS resolve_date FROM E""",
    "q28_promote": f"WITH {_ARTIFACT_SQL} SELECT model, artifact, 'prod' AS alias FROM M WHERE artifact NOT IN (SELECT artifact FROM V) QUALIFY row_number() OVER (PARTITION BY model ORDER BY created_at DESC, artifact DESC) = 1",
    "q29_feature_shards": "WITH N AS (SELECT DISTINCT 'feature_' || (generate_subscripts(embedding, 1)-1) AS feature FROM embeddings), O AS (SELECT feature, row_number() OVER (ORDER BY sha256('0:' || feature), feature)-1 AS rn, count(*) OVER () AS total FROM N), H AS (SELECT feature, least(rn // greatest(total // 3, 1), 2) AS shard, total FROM O), X AS (SELECT H.*, seed, k FROM H, (VALUES (42,0),(1337,1),(2026,2)) v(seed,k)) SELECT seed, feature FROM X QUALIFY row_number() OVER (PARTITION BY seed ORDER BY (shard = k)::INT DESC, sha256(seed || ':' || feature), feature) <= 24 OR total <= 24",
    "q30_feature_neutralize": "WITH E AS (SELECT CAST(vec_id AS VARCHAR) AS id, CAST(vec_id // 25 + 1 AS INTEGER) AS era_int, label::DOUBLE AS y, embedding[1]::DOUBLE AS x FROM embeddings), F AS (SELECT era_int, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM E GROUP BY 1), R AS (SELECT id, era_int, y - 0.5*(a+b*x) AS r FROM E JOIN F USING (era_int)) SELECT id, era_int, round(r/stddev_pop(r) OVER (PARTITION BY era_int), 6) + 0.0 AS neutral FROM R",
    "q48_era_fit": f"{WITH_LARGE}, F AS ({_sql_fit('A', 'prediction', 'era_int').replace('g_bench', 'bench')}) SELECT id, era_int, round((prediction - 0.5*(b0+b1*bench_qty+b2*bench_disc))/sqrt(vy-cf+0.25*vf), 6) + 0.0 AS neutral FROM A JOIN F USING (era_int)",
    "q49_era_fit_of_all_features": "SELECT CAST(vec_id % 4 AS INTEGER) AS era_int, feature, 0.0::DOUBLE AS product, 1.0::DOUBLE AS sd FROM embeddings, (SELECT 'one' AS feature UNION ALL SELECT 'feature_' || k FROM range(64) r(k)) GROUP BY 1, 2",
    "q52_split_profile": f"""WITH {SQL_ROWS}, {SQL_BENCH}, N AS (SELECT id, bench_qty, CASE WHEN id::BIGINT % 11 <> 0 THEN bench_disc END AS bench_disc FROM B), T AS (SELECT * FROM N WHERE id::BIGINT % 3 <> 0), V AS (SELECT * FROM N WHERE id::BIGINT % 3 = 0 OR id::BIGINT % 7 = 0),
      J AS (SELECT 'train' AS split, R.id, T.id AS b, bench_qty, bench_disc FROM R LEFT JOIN T USING (id) WHERE era_int <= 40 UNION ALL SELECT 'validation', R.id, V.id, bench_qty, bench_disc FROM R LEFT JOIN V USING (id) WHERE era_int > 40
        UNION ALL SELECT 'all', R.id, N.id, bench_qty, bench_disc FROM R LEFT JOIN N ON R.id = N.id)
      SELECT split, count(*) AS n_rows, count(b) AS n_covered, count(*) - count(b) AS n_missing, round(count(b) / count(*), 6) AS coverage,
        CASE WHEN split = 'all' THEN (SELECT count(*) FROM T JOIN V USING (id)) ELSE 0 END AS n_repeated, round(count(*) FILTER (b IS NOT NULL AND bench_qty IS NULL) / count(b), 6) AS null_ratio_bench_qty, round(count(*) FILTER (b IS NOT NULL AND bench_disc IS NULL) / count(b), 6) AS null_ratio_bench_disc FROM J GROUP BY split""",
    "q53_expanding_fits": f"{WITH_A}, {SQL_WINDOWS}, X AS (SELECT A.*, window_id FROM A JOIN W ON era_int BETWEEN train_start AND train_end), F AS ({_sql_fit('X', 'prediction', 'window_id').replace('g_bench', 'bench')}) SELECT window_id, (SELECT count(*) FROM X WHERE X.window_id = F.window_id) AS n, round(b0, 3) + 0.0 AS intercept, round(b1, 3) + 0.0 AS bench_qty, round(b2, 3) + 0.0 AS bench_disc FROM F",
    "q54_round_trips": f"""{WITH_A}, {SQL_WINDOWS}, {SQL_OOF}, {SQL_SCORES}, M AS (SELECT DISTINCT 'm' || k AS m, j, 'feature_' || j AS f FROM (SELECT unnest(range(len(embedding))) AS j FROM embeddings), range(5) r(k) WHERE (j + k) % 3 = 0),
      Z AS (SELECT * FROM A WHERE era_int % 5 <> 0)
      SELECT sink, n, round(total, 3) AS total FROM (SELECT 'split' AS sink, count(*) AS n, sum(bench_qty + target::FLOAT::DOUBLE) AS total FROM Z UNION ALL SELECT 'prepared', count(*), sum(bench_qty) FROM Z
      UNION ALL SELECT 'live', count(*), sum(round(bench_disc, 6)) FROM A UNION ALL SELECT 'benchmarks', count(*), sum(bench_qty + length(id)) FROM B UNION ALL SELECT 'submission', count(*), sum(prediction + length(id)) FROM A
      UNION ALL SELECT 'snapshot', count(*), sum(primary_score + CAST(substr(fetched_at, 9, 2) AS INTEGER)) FROM S UNION ALL SELECT 'history ' || x, count(*), sum(primary_score + round_number + resolved::INT) FROM S, (VALUES ('parquet'), ('csv')) v(x) GROUP BY x
      UNION ALL SELECT 'oof', count(*), sum(prediction + window_id) FROM OOF UNION ALL SELECT 'oof of two', count(*), sum(prediction) FROM OOF WHERE window_id IN (3, 4) UNION ALL SELECT 'report', count(*), sum(n + era_int) FROM (SELECT era_int, count(*) AS n FROM A GROUP BY 1)
      UNION ALL SELECT 'model features', count(*), sum(p + length(m)) FROM (SELECT m, row_number() OVER (PARTITION BY m ORDER BY j) - 1 AS p FROM M) UNION ALL SELECT 'catalog', count(*), sum(p + length(f)) FROM (SELECT f, row_number() OVER (ORDER BY j) - 1 AS p FROM M WHERE m = 'm1'))""",
    "q55_row_sample": f"WITH {SQL_ROWS} SELECT id, era_int FROM R ORDER BY sha256('7:' || id), id LIMIT 2000",
    "q56_member_features": f"""WITH {SQL_MAPPING}, L AS (SELECT k, substr(sha256(string_agg(f, chr(10) ORDER BY j)), 1, 16) AS h, count(*) AS n FROM M GROUP BY k)
      SELECT CAST(k AS INTEGER) AS seed, CASE k WHEN 2 THEN 'lost' ELSE 'm' || k END AS model_file, CASE k WHEN 1 THEN repeat('0', 16) WHEN 4 THEN '' ELSE h END AS features_hash, CAST(CASE k WHEN 3 THEN 7 ELSE n END AS INTEGER) AS n_features_used,
        CASE k WHEN 1 THEN 'hash' WHEN 2 THEN 'no_features' WHEN 3 THEN 'count' END AS problem FROM L""",
    "q57_feature_union": f"WITH {SQL_MAPPING} SELECT CAST(row_number() OVER (ORDER BY f) - 1 AS INTEGER) AS pos, f AS feature FROM (SELECT DISTINCT f FROM M WHERE k IN (0, 1, 3))",
    "q58_prediction_stats": f"WITH {SQL_ROWS} SELECT round(min(u), 6) AS min, round(max(u), 6) AS max, round(stddev_pop(u), 6) AS std FROM (SELECT {sql_share('prediction', 'era_int')} AS u FROM R)",
    "q59_feature_choice": "SELECT feature FROM (SELECT DISTINCT 'feature_' || (generate_subscripts(embedding, 1)-1) AS feature FROM embeddings) ORDER BY sha256('1337:' || feature), feature LIMIT 24",
    "q60_scan_points": f"WITH {SQL_ROWS}, {SQL_WINDOWS} SELECT DISTINCT window_id, CAST(i AS INTEGER) AS iter FROM W, range(1, 2000) r(i) WHERE (i % 7 = 0 AND i <= train_end) OR i = train_end",
    "q61_sparse_columns": f"{WITH_A} SELECT id, round(bench_qty, 6) AS bench_qty, round(bench_disc, 6) AS bench_disc, bench_present, 'bench_sparse' AS dropped FROM A",
    "q31_member_summary": f"WITH {SQL_SCORES}, M AS (SELECT CAST(model_name AS INTEGER) AS seed, count(*) AS n, avg(primary_score) AS r, CASE WHEN count(*) % 7 = 0 THEN NULL ELSE max(primary_score) END AS c FROM S GROUP BY 1) SELECT round(avg(n), 6) AS mean_best_iteration, round(avg(r), 6) + 0.0 AS mean_rmse, round(avg(c), 6) + 0.0 AS mean_corr, round(max(c), 6) + 0.0 AS max_corr, (SELECT seed FROM M WHERE c IS NOT NULL ORDER BY c DESC, seed LIMIT 1) AS best_seed, count(*) AS n_models, (SELECT count(DISTINCT event_type) FROM events) AS n_features FROM M",
    "q34_ensemble": f"WITH {SQL_ROWS} SELECT id, round(CAST(CAST((prediction + prediction*2 + target*4)/3 AS FLOAT) AS DOUBLE), 0) AS prediction FROM R",
    "q35_live_alignment": f"{WITH_A} SELECT id, round(bench_qty, 6) AS bench_qty, round(bench_disc, 6) AS bench_disc, bench_present FROM A WHERE bench_present",
    "q36_benchmark_profile": f"WITH {SQL_BENCH} SELECT count(*) AS n_rows, 3 AS n_columns, count(DISTINCT id) AS n_ids FROM B",
    "q37_coverage_by_era": f"{WITH_A} SELECT era_int, round(avg(bench_present::INT), 6) AS coverage, count(*) AS n_rows FROM A GROUP BY 1",
    "q38_intra_round": """WITH E AS (SELECT CAST(user_id AS VARCHAR) AS model_name, CAST(dayofyear(ts) AS INTEGER) AS round_number, event_id, event_type, round(value, 4) AS v, CASE WHEN event_id % 3 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS day FROM events),
      G AS (SELECT model_name, round_number, arg_max(v, event_id) FILTER (event_type = 'click') AS corr20,
        coalesce(arg_max(v, event_id) FILTER (event_type = 'view'), arg_max(v, event_id) FILTER (event_type = 'error')) AS bmc20, arg_max(v, event_id) FILTER (event_type = 'signup') AS fnc,
        CASE WHEN count(*) FILTER (event_id % 4 = 0) > 0 THEN 1.5::DOUBLE * count(*) FILTER (event_id % 4 = 0) ELSE 0.5::DOUBLE * count(*) END AS payout, arg_max(day, event_id) AS resolve_date FROM E GROUP BY 1, 2)
      SELECT model_name, round_number, round(corr20, 6) AS corr20, round(bmc20, 6) AS bmc20, round(fnc, 6) AS fnc, round(payout, 6) AS payout, round(0.75 * corr20 + 2.25 * bmc20, 6) AS primary_score,
        resolve_date, coalesce(CAST(resolve_date AS DATE) <= DATE '2024-01-20', false) AS resolved FROM G""",
    "q39_nested_snapshots": """WITH E AS (SELECT CAST(event_id AS VARCHAR) AS model_name, event_id % 4 AS k, CAST(dayofyear(ts) AS INTEGER) AS n, round(value, 4) AS v, strftime(ts, '%Y-%m-%d') AS day FROM events)
      SELECT model_name, CASE WHEN k = 2 THEN 'own' ELSE 'api' END AS source, n AS round_number, CASE WHEN k = 0 THEN true ELSE CAST(day AS DATE) <= DATE '2024-01-20' END AS resolved,
        CASE WHEN k < 2 THEN v END AS corr20, CASE k WHEN 0 THEN v WHEN 1 THEN 9.0::DOUBLE END AS mmc20, CASE WHEN k = 1 THEN v END AS bmc20, CASE WHEN k = 2 THEN v END AS payout, CASE WHEN k = 2 THEN 1.0::DOUBLE END AS stake,
        CASE WHEN k < 2 THEN round(3.0 * v, 6) END AS primary_score, CASE k WHEN 1 THEN day WHEN 2 THEN day || 'T00:00:00Z' END AS resolve_date FROM E WHERE k < 3""",
    "q40_walkforward_selection": "WITH " + SQL_KNOWN.format(only="true", corr=sql_era_corr("L", "window_id, iter, era_int")) + " SELECT window_id, best_iter, round(corr, 6) + 0.0 AS corr, round(rmse, 6) AS rmse FROM B",
    "q41_oof": "WITH "
    + SQL_KNOWN.format(only="bench_present AND (era_int > 16 OR era_int % 3 = 0)", corr=sql_era_corr("L", "window_id, iter, era_int"))
    + " SELECT window_id, CAST(vec_id AS VARCHAR) AS id, round(CAST(CAST(CASE best_iter WHEN 2 THEN p2 WHEN 3 THEN p3 ELSE p4 END AS FLOAT) AS DOUBLE), 5) + 0.0 AS prediction FROM V JOIN B USING (window_id) WHERE window_id > 1",
    "q42_score_ensemble": "SELECT CAST(vec_id AS VARCHAR) AS id, round(CAST(CAST((embedding[6]::DOUBLE - 2*embedding[10]::DOUBLE + 4*embedding[64]::DOUBLE) / 2 AS FLOAT) AS DOUBLE), 5) + 0.0 AS prediction FROM embeddings",
}
ORACLES["q47_boosted_errors"] = _sql_boosted()
ORACLES["q62_final_fit"] = _sql_boosted(4, train="true", result="SELECT a::DOUBLE AS a, b::DOUBLE AS b, c::DOUBLE AS c, count(*) AS n, round(avg(f), 6) AS prediction FROM R4 GROUP BY 1, 2, 3")
ORACLES["q32_stream_history"] = ORACLES["q21_history_dedup"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: f for name, f in sorted(globals().items()) if name[0] == "q" and name[1:3].isdigit()}
