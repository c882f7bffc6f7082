"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base patterns find assignments, access keys and long hexadecimal runs in each
text. The method then looks at every candidate value of the corpus, generic
mixed tokens included, hashes it, and counts the distinct repositories and owners
that hold it. A value that many owners hold, or many repositories of one owner, is a widely
copied example; one that stays with ``max_owners`` owners and ``max_repos`` repositories
(counted once for each owner) looks live. Live generic tokens are added to the
spans as kind ``owned``; base spans always stay and are counted as live or shared.

Shape of the work: one pass of the patterns keeps the few texts with any
candidate, and only those are shuffled. Frequencies come from partial counts, so
a value held by a third of all rows costs one counter per task; the join of
frequencies back to candidates is an ordinary equi-join whose skewed keys Spark
splits.

Defined cases: a null text is empty and has no spans; null owners count as one
owner, null repositories as one repository; repeated rows repeat their result
and count once in frequencies; extra columns are ignored; texts are scanned whole.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eraloom.plans.scratch import materialize

#: Fixed patterns: kind, pattern, group of the secret value, least length of the value.
KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"(AKIA[A-Z0-9]{14,})", 1, 18),
    ("hex", r"([0-9a-f]{16,})", 1, 16),
    ("owned", r"([A-Za-z0-9+/_=-]{20,})", 1, 20),
]
BASE = [k[0] for k in KINDS[:3]]


def _matches(rows: DataFrame, kind: str, pattern: str, group: int, least: int) -> DataFrame:
    """(doc_id, key, kind, start, stop, value) of a kind's matches.

    The pieces between matches and the matches themselves alternate, so running
    lengths give every match's place.
    """
    p = F.lit(pattern)
    zipped = F.arrays_zip(F.split("text", pattern, -1).alias("piece"), F.regexp_extract_all("text", p, 0).alias("found"), F.regexp_extract_all("text", p, group).alias("value"))
    parts = rows.where(F.col("text").rlike(pattern)).select("doc_id", "key", F.posexplode(zipped).alias("pos", "part")).select("doc_id", "key", "pos", "part.*")
    upto = Window.partitionBy("doc_id", "key").orderBy("pos")
    stop = F.sum(F.char_length("piece") + F.coalesce(F.char_length("found"), F.lit(0))).over(upto)
    placed = parts.withColumn("stop", stop).where(F.col("found").isNotNull() & (F.char_length("value") >= least))
    return placed.select("doc_id", "key", F.lit(kind).alias("kind"), (F.col("stop") - F.char_length("found")).alias("start"), "stop", "value")


def _live_looking(value: Column) -> Column:
    """Letters and digits mixed, at least 10 different characters, not a base hexadecimal run."""
    return ~value.rlike("^[0-9a-f]+$") & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 10)


def find_secrets(docs: DataFrame, owner: str = "source", repo: str = "doc_id", max_owners: int = 1, max_repos: int = 10) -> DataFrame:
    """Spans of all documents: doc_id, key (hash of the text), kind, start, stop,
    n_owners, n_repos and live. ``owner`` and ``repo`` name columns of ``docs``."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("key"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.coalesce(F.col(repo).cast("string"), F.lit("")).alias("repo"))
    some = F.lit(False)
    for _, pattern, _, _ in KINDS:
        some = some | F.col("text").rlike(pattern)
    rows = materialize(rows.where(some), "secret-texts")
    once = rows.select("doc_id", "key", "text").dropDuplicates(["doc_id", "key"])
    found = [_matches(once, *k) for k in KINDS]
    found[-1] = found[-1].where(_live_looking(F.col("value")))
    spans = found[0]
    for more in found[1:]:
        spans = spans.union(more)
    spans = materialize(spans.withColumn("hash", F.sha2("value", 256)).drop("value"), "secret-spans")
    holders = rows.select(F.col("doc_id").alias("id"), F.col("key").alias("k"), "owner", "repo").distinct()
    held = spans.select("doc_id", "key", "hash").distinct().join(holders, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("k")))
    # Two levels, so that a value copied everywhere is counted from partial results.
    by_owner = held.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one")).groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    frequency = by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))
    judged = spans.join(frequency, "hash").withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos))
    return judged.where(F.col("live") | (F.col("kind") != "owned")).select("doc_id", "key", "kind", "start", "stop", "n_owners", "n_repos", "live")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def summarize(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Per document row: counts by kind, the digest of the base spans, all spans as text,
    live and shared spans, and the most repositories that hold one of its values."""
    item = F.struct("start", F.array_position(F.array(*(F.lit(k[0]) for k in KINDS)), F.col("kind")).alias("order"), "stop", "kind")
    counts = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE]
    lists = spans.groupBy(F.col("doc_id").alias("id"), F.col("key").alias("k")).agg(
        *counts, F.array_sort(F.collect_list(item)).alias("all"), F.count(F.when(F.col("live"), 1)).alias("n_live"), F.count(F.when(~F.col("live"), 1)).alias("n_shared"), F.max("n_repos").alias("most_repos")
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"))
    out = rows.join(lists, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("k")), "left")
    every = F.coalesce(F.col("all"), F.array().cast(lists.schema["all"].dataType))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    base = F.filter(every, lambda s: s["kind"].isin(BASE))
    return out.select("doc_id", *(zero(f"n_{k}") for k in BASE), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(every).alias("spans"), zero("n_live"), zero("n_shared"), zero("most_repos"))


def redact(docs: DataFrame, spans: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, every span of a text replaced by ``mark``."""
    lists = spans.groupBy(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("__spans"))
    rows = docs.withColumn("__hash", F.xxhash64("text")).join(lists, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__key")), "left")
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        between = F.concat(acc["out"], F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.when(fresh, between).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("__spans", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], F.substring(text, a["at"].cast("int") + 1, F.char_length(text))))
    return rows.withColumn("text", F.when(F.col("__spans").isNull(), text).otherwise(done)).select(*docs.columns)
