"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

Every benchmark item is cut into windows of ``window`` consecutive words (a
shorter item is one window). A window can occur in a document only if all its
shingles do, so it is enough to look documents up by each window's rarest shingle:

1. document frequencies of the benchmark's shingles are counted over the whole
   corpus (one pass, partial aggregation, no document text is shuffled);
2. each window's shingles are ordered by that frequency; the rarest is its prefix
   token, stored with its offset in the window. For exact containment (similarity
   1) the necessary prefix is one token long;
3. documents' shingles, as positions and hashes only, join the prefix tokens; the
   position bound places the window at ``position - offset``, the length bound drops
   windows that would reach past either end;
4. candidates meet their document's words, and what remains is verified word by word
   over the item-sized window.

The lookup side holds at most one row per benchmark word; it is broadcast only
when its counted rows are under ``broadcast_rows``, else the same joins shuffle.
Overlapping hits are merged with a running maximum, so a word counts once.

Defined cases: a null or wordless text has no words and is not contaminated;
items that are null or wordless have no window and are never hit; an item whose
words occur in a document only across its windows is hit where a window is.
Texts are read whole, however long. Repeated document rows repeat their result; item ids that repeat are listed once
each; a null item_id hits words but is not listed or counted among the items.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eraloom.plans.scratch import broadcast_if_small, materialize

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased: digits, letters a-z and all beyond ASCII."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(low, _SEPARATORS), "")


def _key(tokens: str, at: Column, size: Column | int) -> Column:
    """Hash of up to three words of an array from a 0-based position."""
    size = size if isinstance(size, Column) else F.lit(size)
    return F.xxhash64(*(F.when(size > k, F.get(F.col(tokens), at + k)) for k in range(3)))


def windows(items: DataFrame, window: int = 10) -> DataFrame:
    """item_id, n (words) and the words of every distinct window."""
    cut = items.select("item_id", words(F.col("text")).alias("w")).withColumn("n", F.least(F.size("w"), F.lit(window))).where("n > 0")
    starts = F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)
    return cut.select("item_id", "n", "w", F.explode(starts).alias("s")).select("item_id", F.col("n").cast("int").alias("n"), F.expr("slice(w, s, n)").alias("win")).distinct()


def find_windows(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3, broadcast_rows: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """The documents with their words (key, doc_id, n_words), and each occurrence
    of a window as (key, item_id, start, stop)."""
    size = F.least(F.lit(shingle), F.col("n"))
    wins = materialize(windows(benchmark, window), "windows")
    parts = wins.select("item_id", "n", "win", size.alias("k"), F.explode(F.sequence(F.lit(0), F.col("n") - size)).alias("offset"))
    parts = materialize(parts.withColumn("token", _key("win", F.col("offset"), F.col("k"))), "window-shingles")
    n_parts = parts.count()
    # Shingle sizes in use: the full one, and shorter ones where whole items are shorter.
    sizes = sorted(r["k"] for r in parts.select("k").distinct().collect())
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    tokens = rows.select("doc_id", "key", words(F.col("text")).alias("w"))
    filled = tokens.withColumn("size", F.size("w")).where("size > 0")

    def hashes(k: int) -> Column:
        """Hashes of the k-word shingles that start at each word; those that reach past the end match nothing."""
        return F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda at: _key("w", at, k))

    def shingles(*keep: str) -> DataFrame:
        """Position and token of every shingle of every size in use."""
        if len(sizes) <= 1:
            return filled.select(*keep, F.posexplode(hashes(sizes[0] if sizes else shingle)).alias("pos", "token"))
        every = F.arrays_zip(*(hashes(k).alias(f"k{k}") for k in sizes))
        return filled.select(*keep, F.posexplode(every).alias("pos", "t")).select(*keep, "pos", F.explode(F.array(*(F.col("t")[f"k{k}"] for k in sizes))).alias("token"))

    wanted = parts.select("token").distinct()
    seen = shingles().select("token").join(broadcast_if_small(wanted, n_parts, broadcast_rows), "token").groupBy("token").agg(F.count("*").alias("df"))
    rank = Window.partitionBy("item_id", "win").orderBy("df", "offset")
    # A window with a shingle that no document holds occurs nowhere.
    ranked = parts.join(seen, "token", "left").withColumn("df", F.coalesce("df", F.lit(0))).withColumn("rank", F.row_number().over(rank))
    prefix = materialize(ranked.where("rank = 1 and df > 0").select("token", "offset", "n", "win", "item_id"), "window-prefixes")
    probe = shingles("doc_id", "key", "size")
    start = F.col("pos") - F.col("offset")
    places = probe.join(broadcast_if_small(prefix, n_parts, broadcast_rows), "token").where((start >= 0) & (start + F.col("n") <= F.col("size")))
    place = F.struct(start.alias("start"), "n", "win", "item_id")
    places = places.groupBy(F.col("doc_id").alias("id"), F.col("key").alias("k")).agg(F.collect_list(place).alias("places"))
    both = rows.join(places, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("k")))
    same = F.filter("places", lambda p: F.slice(F.col("w"), p["start"] + 1, p["n"]) == p["win"])
    hits = both.select("doc_id", "key", words(F.col("text")).alias("w"), "places").select("doc_id", "key", F.explode(same).alias("p"))
    hits = hits.select("doc_id", "key", "p.item_id", "p.start", (F.col("p.start") + F.col("p.n")).alias("stop")).distinct()
    return tokens.select("doc_id", "key", F.size("w").cast("long").alias("n_words")), hits


def contamination(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return judge(docs, benchmark, **options).drop("key")


def judge(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """``contamination`` with each row's ``key``, the hash of its text."""
    base, hits = find_windows(docs, benchmark, **options)
    hits = materialize(hits, "window-hits")
    order = Window.partitionBy("doc_id", "key").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))))
    spans = hits.select("doc_id", "key", "start", "stop").distinct().withColumn("fresh", fresh)
    covered = spans.groupBy("doc_id", "key").agg(F.sum("fresh").alias("n_hit"))
    listed = hits.groupBy("doc_id", "key").agg(F.array_sort(F.transform(F.collect_set("item_id"), lambda x: x.cast("string"))).alias("items"))
    found = covered.join(listed, (covered["doc_id"].eqNullSafe(listed["doc_id"])) & (covered["key"] == listed["key"])).select(covered["doc_id"].alias("id"), covered["key"].alias("k"), "n_hit", "items")
    out = base.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("k")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "key")
