"""Score history: normalized snapshots, merging, summary and evidence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eraloom.functions.scalars import clip, json_number, json_text, json_value, json_whole, kind_of, pick, to_double
from eraloom.plans.scratch import materialize, once

#: Fixed format: the history's columns in order.
HISTORY = (
    "fetched_at string, source string, model_name string, round_number int, resolved boolean, corr20 double, mmc20 double, "
    "bmc20 double, fnc double, payout double, stake double, primary_score double, resolve_date string"
)
COLUMNS = [c.split()[0] for c in HISTORY.split(", ")]
KEY = ["source", "model_name", "round_number", "fetched_at"]

#: Accepted keys per field, in lower case and order of preference.
ALIASES = {
    "round_number": ["roundnumber", "round_number", "round", "tournamentround", "tournament_round"],
    "model_name": ["modelname", "model_name", "model"],
    "corr20": ["corr20", "corr_20", "corr"],
    "mmc20": ["mmc20", "mmc_20", "mmc"],
    "bmc20": ["bmc20", "bmc_20", "bmc"],
    "fnc": ["fnc", "fncv3", "fnc_v3"],
    "payout": ["payout", "nmrpayout", "nmr_payout"],
    "stake": ["stake", "stakevalue", "stake_value", "atrisk", "at_risk"],
    "resolved": ["resolved", "isresolved", "is_resolved"],
    "resolve": ["resolve", "resolvedate", "resolve_date", "resolved_at"],
    "resolve_date": ["resolve", "resolvedate", "resolve_date", "resolved_at", "date"],
}
#: Names of intra-round values per field, in order of preference.
INTRA = {
    "corr20": ["v2_corr20", "corr", "canon_corr", "cort20", "canon_cort20"],
    "bmc20": ["bmc", "canon_bmc"],
    "mmc20": ["mmc", "canon_mmc"],
    "fnc": ["fnc_v3", "canon_fnc_v3"],
}
INTRA_ROUND = "array<struct<roundNumber:int,intraRoundSubmissionScores:array<struct<displayName:string,value:string,date:string,payoutPending:string,payoutSettled:string>>>>"


def conform(df: DataFrame, keep: list[str] = []) -> DataFrame:  # noqa: B006
    """The history's columns in order, null where absent, and the columns ``keep``."""
    fields = [f.split() for f in HISTORY.split(", ")]
    return df.select(*((F.col(n).cast(t) if n in df.columns else F.lit(None).cast(t)).alias(n) for n, t in fields), *keep)


def flatten_records(snapshots: DataFrame, value: str = "value", place: str | None = None) -> DataFrame:
    """(every other column, record): each object at any depth of a VARIANT column. ``place`` names a
    column for an object's path of positions; in its order an object comes before what
    it holds, and members of an object go by key, as a VARIANT keeps them.

    Each level of nesting is one explode of the containers of the level before,
    written to the shared folder, until a level holds none; rows are unlimited.
    """
    keep = [c for c in snapshots.columns if c != value]
    if place:
        snapshots = snapshots.withColumn(place, F.array().cast("array<int>"))
    path = [F.concat(place, F.array("pos")).alias(place)] if place else []
    columns = [*keep, *([place] if place else [])]

    def containers(df: DataFrame) -> DataFrame:
        """The objects and arrays, told apart once for the filter, the next level and the result."""
        kind = F.substring(F.schema_of_variant("record"), 1, 5)
        told = once(once(df).select(*columns, "record", kind.alias("__kind"))).where(F.col("__kind").isin("OBJEC", "ARRAY"))
        return materialize(told.select(*columns, "record", (F.col("__kind") == "OBJEC").alias("__object")), "json-level")

    level = containers(snapshots.select(*columns, F.col(value).alias("record")))
    found = level
    while True:
        inside = level.lateralJoin(level.sparkSession.tvf.variant_explode(F.col("record").outer())).select(*keep, *path, F.col("value").alias("record"))
        level = containers(inside)
        if level.isEmpty():
            return found.where("__object").drop("__object")
        found = found.union(level)


def as_map(record: Column) -> Column:
    """An object as a map from lower-case keys to (kind, text) values; of keys that
    differ only in case the last in order counts.

    Each step is an element of a list that the next one walks, so that the values are read once,
    and not once for every place that names them.
    """
    entries = F.map_entries(F.try_variant_get(record, "$", "map<string,variant>"))
    read = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), F.schema_of_variant(e["value"]).alias("kind"), F.variant_get(e["value"], "$", "string").alias("text")))
    named = F.transform(read, lambda e: F.struct(e["key"].alias("key"), F.struct(kind_of(e["kind"]).alias("kind"), e["text"].alias("text")).alias("value")))

    def last(es: Column) -> Column:
        alone = F.size(F.array_distinct(F.transform(es, lambda e: e["key"]))) == F.size(es)
        return F.when(alone, es).otherwise(F.filter(es, lambda e, i: ~F.exists(F.slice(es, i + 2, F.size(es)), lambda x: x["key"] == e["key"])))

    return F.get(F.transform(F.array(named), lambda es: F.map_from_entries(last(es))), F.lit(0))


def passed(date: Column, as_of: Column) -> Column:
    """Whether an ISO date or time, in UTC unless it names a zone, is not after ``as_of``."""
    zoned = F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(date, F.lit("T00:00:00Z"))).when(date.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), date).otherwise(F.concat(date, F.lit("Z")))
    return F.coalesce(zoned.try_cast("timestamp") <= as_of, F.lit(False))


def resolved_flag(flag: Column, date: Column, as_of: Column) -> Column:
    """Explicit flag if there is one (text: 1, true, yes, resolved), else whether the resolve date has passed."""
    said = F.when(flag["kind"] == "text", F.lower(F.trim(flag["text"])).isin("1", "true", "yes", "resolved")).when(flag["kind"].isin("flag", "number"), json_number(flag) != 0)
    return F.coalesce(said, passed(json_text(date), as_of))


def primary_score(corr: Column, bmc: Column, mmc: Column, w_corr: float = 0.75, w_bmc: float = 2.25) -> Column:
    return w_corr * corr + w_bmc * F.coalesce(bmc, mmc)


def usable(rows: DataFrame, keep: list[str] = []) -> DataFrame:  # noqa: B006
    """History rows with a round and any of score, corr and payout."""
    return conform(rows.where(F.col("round_number").isNotNull() & F.coalesce("primary_score", "corr20", "payout").isNotNull()), keep)


def normalize_records(records: DataFrame, as_of: Column, w_corr: float = 0.75, w_bmc: float = 2.25, keep: list[str] = []) -> DataFrame:  # noqa: B006
    """History rows from (fetched_at, source, model_name, record), record as ``as_map`` gives it;
    a record's own source and model name count before its snapshot's."""
    names = {**ALIASES, "own_source": ["source"]}
    # Steps over a list of one: a field's record is read once, and a filter stays above the generator
    # instead of repeating the fields below it.
    picked = F.transform(F.array("record"), lambda r: F.struct(*(pick(r, keys).alias(name) for name, keys in names.items())))
    fields = lambda p: F.struct(
        F.coalesce(json_text(p["own_source"]), "source").alias("source"),
        F.coalesce(json_text(p["model_name"]), "model_name").alias("model_name"),
        json_whole(p["round_number"]).alias("round_number"),
        resolved_flag(p["resolved"], p["resolve"], as_of).alias("resolved"),
        *(json_number(p[name]).alias(name) for name in ("corr20", "mmc20", "bmc20", "fnc", "payout", "stake")),
        json_text(p["resolve_date"]).alias("resolve_date"),
    )
    out = records.select("fetched_at", *keep, F.inline(F.transform(picked, fields)))
    return usable(out.withColumn("primary_score", primary_score(F.col("corr20"), F.col("bmc20"), F.col("mmc20"), w_corr, w_bmc)), keep)


def intra_round_rows(nested: DataFrame, as_of: Column, w_corr: float = 0.75, w_bmc: float = 2.25) -> DataFrame:
    """One history row per round from nested buckets (column ``rounds`` of type
    INTRA_ROUND, with fetched_at, source, model_name); the last bucket of a name wins,
    payouts are the settled sum if any, else the pending sum, the resolve date is the
    last present one and decides whether the round is resolved."""
    return bucket_rows(explode_buckets(nested), as_of, w_corr, w_bmc)


def explode_buckets(nested: DataFrame) -> DataFrame:
    """Nested snapshots as one row per bucket: fetched_at, source, model_name, round_number,
    rpos (the round's place in its snapshot), pos (the bucket's place in its round), b (the bucket)."""
    one = nested.select("fetched_at", "source", "model_name", F.posexplode("rounds").alias("rpos", "round"))
    return one.select("fetched_at", "source", "model_name", F.col("round.roundNumber").alias("round_number"), "rpos", F.posexplode("round.intraRoundSubmissionScores").alias("pos", "b"))


def bucket_rows(buckets: DataFrame, as_of: Column, w_corr: float = 0.75, w_bmc: float = 2.25, keep: list[str] = []) -> DataFrame:  # noqa: B006
    """``intra_round_rows`` from flat buckets, in partial aggregates only; ``pos`` is of any
    type with an order."""
    b = buckets.select("*", F.lower(F.trim("b.displayName")).alias("name"), to_double(F.trim("b.value")).alias("v"), F.nullif(F.col("b.date"), F.lit("")).alias("day"))
    keys = list(dict.fromkeys(["fetched_at", "source", "model_name", "round_number", "rpos", *keep]))
    last = [F.max_by(F.when(F.col("name") == n, F.col("v")), F.when(F.col("name") == n, F.col("pos"))).alias(f"s_{n}") for n in dict.fromkeys(n for names in INTRA.values() for n in names)]
    settled, pending = (F.sum(to_double(F.trim(f"b.payout{k}"))) for k in ("Settled", "Pending"))
    wide = b.groupBy(*keys).agg(*last, F.coalesce(settled, pending).alias("payout"), F.max_by("day", F.when(F.col("day").isNotNull(), F.col("pos"))).alias("resolve_date"))
    out = wide.select("*", passed(F.col("resolve_date"), as_of).alias("resolved"), *(F.coalesce(*(F.col(f"s_{n}") for n in names)).alias(k) for k, names in INTRA.items()))
    return usable(out.withColumn("primary_score", primary_score(F.col("corr20"), F.col("bmc20"), F.col("mmc20"), w_corr, w_bmc)), keep)


#: Fixed value: the method whose payload holds rounds of named scores.
INTRA_METHOD = "intra_round_scores"


def payload_buckets(payloads: DataFrame) -> DataFrame:
    """Flat buckets (see ``explode_buckets``) of the intra-round method's VARIANT payloads;
    what is no round, no list of scores or no score object is passed over."""
    kind = lambda c: F.schema_of_variant(c)
    lists = payloads.where((F.col("source") == INTRA_METHOD) & kind("value").startswith("ARRAY"))
    keep = ["fetched_at", "source", "model_name", "mpos"]
    tvf = payloads.sparkSession.tvf
    rounds = lists.lateralJoin(tvf.variant_explode(F.col("value").outer()).select(F.col("pos").alias("rpos"), F.col("value").alias("round"))).select(*keep, "rpos", "round").where(kind("round").startswith("OBJECT"))
    scores = F.try_variant_get("round", "$.intraRoundSubmissionScores", "array<variant>")
    number = json_whole(json_value(F.try_variant_get("round", "$.roundNumber", "variant")))
    rounds = rounds.select(*keep, "rpos", "round", number.alias("round_number"))
    items = rounds.select(*keep, "rpos", "round_number", F.posexplode(scores).alias("pos", "item")).where(kind("item").startswith("OBJECT"))
    at = lambda name: json_value(F.try_variant_get("item", f"$.{name}", "variant"))
    text = lambda name: json_text(at(name)).alias(name)
    digits = lambda name: json_number(at(name)).cast("string").alias(name)
    return items.select(*keep, "rpos", "round_number", "pos", F.struct(text("displayName"), digits("value"), text("date"), digits("payoutPending"), digits("payoutSettled")).alias("b"))


def normalize_payloads(payloads: DataFrame, as_of: Column, w_corr: float = 0.75, w_bmc: float = 2.25) -> DataFrame:
    """History rows of fetched payloads (fetched_at, model_name, source, mpos, ok, value): the
    method's name is the source and mpos its place in the fetch, value a VARIANT.

    Payloads without ``ok`` count nowhere. A payload of the intra-round method gives its rounds first,
    then every payload gives each object it holds; of rows with one key the last in this order stays.
    """
    good = materialize(payloads.where("ok").select("fetched_at", "source", "model_name", "mpos", "value"), "payloads")
    records = flatten_records(good, place="place").select("fetched_at", "source", "model_name", "mpos", "place", as_map(F.col("record")).alias("record"))
    flat = normalize_records(records, as_of, w_corr, w_bmc, ["mpos", "place"]).withColumn("kind", F.lit(1))
    intra = bucket_rows(payload_buckets(good), as_of, w_corr, w_bmc, ["mpos", "rpos"])
    intra = intra.select(*COLUMNS, "mpos", F.array(F.col("rpos").cast("int")).alias("place"), F.lit(0).alias("kind"))
    both = flat.unionByName(intra)
    last = both.groupBy(*KEY).agg(F.max_by(F.struct(*COLUMNS), F.struct("mpos", "kind", "place")).alias("row"))
    return last.select("row.*")


def _ties(columns: list[str], keys: list[str]) -> list[Column]:
    """An order among rows of equal standing: by all other history columns."""
    return [F.desc_nulls_last(c) for c in COLUMNS if c in columns and c not in keys]


def keep_last(df: DataFrame, order: str, keys: list[str] = KEY) -> DataFrame:
    """The row of the largest ``order`` (ingest ordinal, null least) for each key; of equal ones the largest in the other columns."""
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order), *_ties(df.columns, keys))
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def merge_history(old: DataFrame, new: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Union in which new rows replace old ones of the same key. Where rows carry an
    ``ingest_seq`` the larger one counts, on whichever side it is, and the side decides
    among equal ones; without it the order inside each side is by all columns."""
    both = old.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    seq = [F.desc_nulls_last("ingest_seq")] if "ingest_seq" in both.columns else []
    w = Window.partitionBy(*keys).orderBy(*seq, F.desc("__side"), *_ties(both.columns, keys))
    return both.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__side")


def latest_rounds(history: DataFrame, n: int, by: list[str] = []) -> DataFrame:  # noqa: B006
    """One row for each of the latest n resolved rounds with a score: the newest fetch, then source."""
    usable = history.where(F.col("resolved") & F.col("primary_score").isNotNull() & F.col("round_number").isNotNull())
    one = Window.partitionBy(*by, "round_number").orderBy(F.desc("fetched_at"), "source", "model_name")
    rounds = usable.withColumn("__k", F.row_number().over(one)).where("__k = 1").drop("__k")
    if not by:
        return rounds.orderBy(F.desc("round_number")).limit(n)
    return rounds.withColumn("__k", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("round_number")))).where(F.col("__k") <= n).drop("__k")


def summarize_history(history: DataFrame) -> DataFrame:
    return history.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("resolved").alias("n_resolved"),
        F.min("round_number").alias("min_round"),
        F.max("round_number").alias("max_round"),
        F.array_sort(F.collect_set("source")).alias("sources"),
    )


@dataclass(frozen=True)
class EvidenceConfig:
    lookback_rounds: int = 20
    min_resolved_rounds: int = 2
    threshold: float = 65.0


def score_evidence(history: DataFrame, config: EvidenceConfig = EvidenceConfig(), by: list[str] = []) -> DataFrame:  # noqa: B006, B008
    """Evidence over the latest resolved rounds, for all models together or per ``by``:
    50, +20 with enough rounds, up to 15 for the mean, up to 10 for hits, up to -10
    for losing rounds, -5 for a wide spread, kept within 0 and 100; 0 without any round."""
    s = F.col("primary_score")
    stats = latest_rounds(history, config.lookback_rounds, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(s).alias("mean_score"), F.avg((s > 0).cast("double")).alias("hit_rate"), F.count_if(s < 0).alias("downside"), F.stddev_pop(s).alias("std_score")
    )
    enough = F.col("n") >= config.min_resolved_rounds
    n = F.greatest(F.col("n"), F.lit(1))
    points = (
        F.lit(50.0)
        + F.when(enough, F.lit(20.0)).otherwise(0.0)
        + clip(F.col("mean_score") / 0.02 * 15, -15.0, 15.0)
        + clip((F.col("hit_rate") - 0.5) / 0.5 * 10, -10.0, 10.0)
        - F.least(F.lit(10.0), F.col("downside") / n * 10)
        - F.when(F.col("std_score") > 0.03, F.lit(5.0)).otherwise(0.0)
    )
    score = F.when(F.col("n") == 0, F.lit(0.0)).otherwise(clip(points, 0.0, 100.0))
    out = stats.withColumn("evidence", score)
    verdict = enough & (F.col("evidence") >= config.threshold)
    why = F.concat_ws("; ", F.format_string("%d resolved rounds", "n"), F.format_string("mean %.4f", F.coalesce("mean_score", F.lit(0.0))), F.format_string("hit rate %.2f", F.coalesce("hit_rate", F.lit(0.0))))
    return out.withColumn("sufficient", verdict).withColumn("reasoning", why)
