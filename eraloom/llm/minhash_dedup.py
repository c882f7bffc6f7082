"""b-bit MinHash near-duplicate detection.

Every text's distinct word shingles get ``bands * rows`` minima. Bands of minima
give candidate pairs; the low ``BITS`` bits of every minimum, packed into longs,
estimate a candidate's similarity by counting equal groups of bits, corrected for
the groups that are equal by accident. What the estimate cannot rule out is
confirmed on the full shingle sets, so no reported link is approximate. With the
defaults (40 bands of 6) a pair at Jaccard 0.85 escapes all bands with
probability 6e-9, one at 0.80 with 5e-6.

Shape of the work at scale:

* texts with equal shingle sets fall into one *class* first, so thousands of
  exact copies cost one node;
* inside a bucket only star edges to the bucket's smallest class are tested
  first. Members of buckets that still hold several components go to a second
  round with ``WIDE_BANDS`` longer bands (as long as a pair at the threshold
  escapes all of them with probability under 1e-5) and two bits of every minimum:
  a much sharper estimate, tested inside the join, so that pairs just under the
  threshold, of which a group of loose copies has very many, are not made at all.
  A few more rounds of star edges, each with another hub out of a bucket's largest
  component, join what links at all; then the pairs of components that still are
  apart are tested, with a side outside the bucket's largest one. Near-copies that
  are connected never form pairs again, yet no link between components is lost
  beyond that probability;
* components come from min-label propagation with pointer jumping on tables in
  the shared folder; nothing is collected.

Defined cases: a null or blank text has an empty set and links with nothing. A
text of fewer words than a shingle is one shingle, its whole sequence. Repeated
rows give repeated results. Rows of one doc_id with different texts are judged
each by its own set. Rows with a null doc_id take part; a class without any
doc_id has a null component and its rows are kept. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eraloom.llm.text import WordHash, map_rows, shingles
from eraloom.plans.scratch import broadcast_if_small, materialize

BITS = 4
WIDE_BANDS = 120
WIDE_BITS = 2
#: Standard errors below the threshold at which an estimate still is confirmed: missed with probability 3e-6.
SLACK = 4.5
#: More rounds of star edges between components before all remaining pairs of them are tested.
HUB_ROUNDS = 1
#: Linked nodes up to which their labels are broadcast (about 2 MB).
FEW = 20_000


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 2**32, n, np.uint32) | np.uint32(1), rng.integers(0, 2**32, n, np.uint32)


def minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a set, in blocks that fit a cache."""
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    for f in range(0, len(a), 240):
        part = slice(f, f + 240)
        for k in range(0, len(x), 512):
            np.minimum(out[part], (a[part, None] * x[None, k : k + 512] + b[part, None]).min(axis=1), out=out[part])
    return out


def pack(mins: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Low ``bits`` bits of each minimum, 64 / bits to a long."""
    held = 64 // bits
    low = (mins & np.uint32(2**bits - 1)).astype(np.uint64)
    low = np.pad(low, (0, -len(low) % held)).reshape(-1, held)
    return (low << (np.arange(held, dtype=np.uint64) * np.uint64(bits))).sum(axis=1, dtype=np.uint64).view(np.int64)


def band_keys(mins: np.ndarray, rows: int) -> list[int]:
    """One key for each run of ``rows`` minima."""
    return [xxhash.xxh3_64_intdigest(r.tobytes(), seed=k) - 2**63 for k, r in enumerate(mins.reshape(-1, rows))]


def wide_rows(percent: int) -> int:
    """Most rows of a band at which a pair at the threshold escapes WIDE_BANDS bands with probability under 1e-5."""
    rows = 1
    while (1 - (percent / 100) ** (rows + 1)) ** WIDE_BANDS < 1e-5 and rows < 64:
        rows += 1
    return rows


def _signer(shingle: int, bands: int, rows: int):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = _functions(bands * rows)
        memo = WordHash()
        for pdf in batches:
            n, ids, keys, packed = [], [], [], []
            for text in pdf["text"]:
                s = shingles(text, shingle, memo)
                n.append(len(s))
                if not len(s):
                    ids.append(None), keys.append(None), packed.append(None)
                    continue
                m = minima(s, a, b)
                ids.append(xxhash.xxh3_128_digest(s.tobytes()))
                keys.append(band_keys(m, rows))
                packed.append(pack(m))
            yield pd.DataFrame({"n_shingles": n, "cls": ids, "bands": keys, "sig": packed})

    return sign


def _wide_signer(shingle: int, rows: int):
    """Like ``_signer``, with WIDE_BANDS bands of ``rows`` (32 bits of their keys) and WIDE_BITS bits, each class of a batch once, beside its set."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = _functions(WIDE_BANDS * rows)
        memo = WordHash()
        for pdf in batches:
            found = {xxhash.xxh3_128_digest(s.tobytes()): s for s in (shingles(t, shingle, memo) for t in pdf["text"])}
            mins = [minima(s, a, b) for s in found.values()]
            bands, sigs = [np.array(band_keys(m, rows)).astype(np.int32) for m in mins], [pack(m, WIDE_BITS) for m in mins]
            yield pd.DataFrame({"cls": list(found), "bands": bands, "sig": sigs, "items": [s.view(np.int64) for s in found.values()]})

    return sign


def _set_reader(shingle: int):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHash()
        for pdf in batches:
            found = {xxhash.xxh3_128_digest(s.tobytes()): s.view(np.int64) for s in (shingles(t, shingle, memo) for t in pdf["text"])}
            yield pd.DataFrame({"cls": list(found), "items": list(found.values())})

    return read


def _mismatches(longs: int, bits: int = BITS) -> Column:
    """Number of unequal bit groups of two packed signatures, as a column expression."""
    total = F.lit(0)
    ones = sum(1 << k for k in range(0, 64, bits))
    for k in range(longs):
        d = F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}"))
        if bits > 1:
            d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
            for step in range(2, bits, 2):
                d = d.bitwiseOR(F.shiftrightunsigned(d, step))
            d = d.bitwiseAND(F.lit(ones))
        total = total + F.bit_count(d)
    return total


def most_mismatches(width: int, percent: int, bits: int = BITS) -> int:
    """Unequal groups out of ``width`` up to which a pair is worth confirming: the similarity
    corrected for groups that are equal by accident lies within SLACK standard errors."""
    j, c = percent / 100, 2.0**-bits
    equal = j + (1 - j) * c
    return width - int(width * (equal - SLACK * (equal * (1 - equal) / width) ** 0.5))


def _side(mark: str, longs: int) -> list[Column]:
    return [F.col("cls").alias(mark), F.col("n").alias(f"n_{mark}"), *(F.col("sig")[k].alias(f"{mark}{k}") for k in range(longs))]


def _near(width: int, percent: int, bits: int = BITS) -> Column:
    """Set sizes and signatures of a pair allow a link."""
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return sizes & (_mismatches(-(-width * bits // 64), bits) <= most_mismatches(width, percent, bits))


def _star(rows: DataFrame, *more: str) -> DataFrame:
    """Distinct edges (a, b) of every row's hub and class, dealt by class as the join on ``b`` needs them."""
    return rows.select(F.col("hub").alias("a"), F.col("cls").alias("b"), *more).repartition("b").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of a written table ``edges(a, b)`` as (cls, root), for linked nodes only.

    Labels start at each node's smallest neighbour or itself. While an edge has
    two labels, a round takes the smallest label around and follows one pointer,
    so chains shorten by half. Each round's table is written to the shared folder;
    labels of few nodes are broadcast.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    labels = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "cls"), f"{name}-labels")
    n = labels.count()
    while True:
        labels = broadcast_if_small(labels, n, FEW)
        apart = edges.join(labels.select(F.col("cls").alias("a"), F.col("root").alias("u")), "a").join(labels.select(F.col("cls").alias("b"), F.col("root").alias("v")), "b").where("u <> v")
        if apart.isEmpty():
            return labels
        around = both.join(labels.withColumnRenamed("cls", "b"), "b").groupBy(F.col("a").alias("cls")).agg(F.min("root").alias("seen"))
        hooked = labels.join(around, "cls").select("cls", F.least("root", "seen").alias("root"))
        parents = labels.select(F.col("cls").alias("root"), F.col("root").alias("up"))
        labels = materialize(hooked.join(parents, "root", "left").select("cls", F.coalesce(F.least("root", "up"), "root").alias("root")), f"{name}-labels")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """The ``pairs(a, b, ...)`` whose full ``sets(cls, items)`` reach the threshold."""
    left = sets.select(F.col("cls").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("items").alias("items_b"))
    inter, union = F.col("inter"), F.size("items_a") + F.size("items_b") - F.col("inter")
    both = pairs.join(right, "b").join(left, "a").withColumn("inter", F.size(F.array_intersect("items_a", "items_b")))
    return materialize(both.where(inter * 100 >= union * percent).select(pairs.columns), f"{name}-links")


def _join_open(texts: DataFrame, members: DataFrame, shingle: int, percent: int) -> list[DataFrame]:
    """Tables (root, top) to apply in turn: components that links of the second round join.
    ``members(cls, root, n)`` are the classes of ``texts`` and their components so far."""
    rows = wide_rows(percent)
    width, longs = WIDE_BANDS * rows, -(-WIDE_BANDS * rows * WIDE_BITS // 64)
    near = _near(width, percent, WIDE_BITS)
    wide = texts.mapInPandas(_wide_signer(shingle, rows), "cls binary, bands array<int>, sig array<long>, items array<long>").dropDuplicates(["cls"])
    wide = materialize(wide.join(members, "cls"), "wide")
    n_wide = wide.count()
    slots = wide.select("cls", "root", F.posexplode("bands").alias("band", "key"))
    placed, tops, turn = members.select("cls", "root"), [], 0
    while True:
        hub = F.min(F.struct(F.xxhash64("cls", F.lit(turn)).alias("order"), "cls"))["cls"].alias("hub")
        sizes = slots.groupBy("band", "key", "root").agg(F.count("*").alias("members"), hub)
        main = F.max_by(F.struct("root", "hub"), F.struct("members", "root"))
        mains = sizes.groupBy("band", "key").agg(main.alias("m"), F.count("*").alias("parts")).where("parts > 1").select("band", "key", F.col("m")["root"].alias("main"), F.col("m")["hub"].alias("hub"))
        mixed = materialize(slots.join(mains, ["band", "key"]), "wide-buckets")
        # Pairs go with their components, ``u`` of a and ``v`` of b.
        if turn < HUB_ROUNDS:
            star = _star(mixed.where("root <> main").withColumnsRenamed({"main": "u", "root": "v"}), "u", "v")
            pairs = star.join(wide.select(*_side("b", longs)), "b").join(wide.select(*_side("a", longs)), "a").where(near).select("a", "b", "u", "v")
        else:
            # A pair with a side in the main component is found from its other side, any other pair from its smaller class.
            # Of the bands that two classes share, the first makes the pair, so that it is made once.
            signed = mixed.join(wide.select("cls", "n", "sig", "bands"), "cls")
            x = signed.where("root <> main").select("band", "key", F.col("root").alias("u"), F.col("bands").alias("bands_a"), *_side("a", longs))
            y = signed.select("band", "key", F.col("root").alias("v"), F.col("main").alias("main_b"), F.col("bands").alias("bands_b"), *_side("b", longs))
            once = (F.col("u") != F.col("v")) & ((F.col("a") < F.col("b")) | (F.col("v") == F.col("main_b")))
            first = F.array_position(F.zip_with("bands_a", "bands_b", lambda p, q: p == q), True) == x["band"] + 1
            pairs = x.join(y, (x["band"] == y["band"]) & (x["key"] == y["key"]) & once & near & first).select("a", "b", "u", "v")
        links = _confirm(materialize(pairs, "wide-pairs"), wide.select("cls", "items"), percent, "wide")
        none = links.isEmpty()
        if not none:
            tops.append(components(links.select(F.col("u").alias("a"), F.col("v").alias("b")), "wide").select(F.col("cls").alias("root"), F.col("root").alias("top")))
        if turn >= HUB_ROUNDS:
            return tops
        if not none:
            placed = placed.join(tops[-1], "root", "left").select("cls", F.coalesce("top", "root").alias("root"))
        slots, turn = mixed.select("cls", "band", "key").join(broadcast_if_small(placed, n_wide, 200_000), "cls"), HUB_ROUNDS if none else turn + 1


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 40, rows: int = 6) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Texts are linked when ``100 * intersection >= percent * union`` of their
    distinct ``shingle``-word shingles; component_id is the smallest doc_id
    reachable over links.
    """
    judged = judge(docs, shingle, percent, bands, rows).select("doc_id", "n_shingles", "component_id")
    return judged.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def judge(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 40, rows: int = 6) -> DataFrame:
    """One row per input row: doc_id, key (the hash of its text), n_shingles, root (the
    component's own mark, null for an empty set) and component_id."""
    width, longs = bands * rows, -(-bands * rows * BITS // 64)
    signed = materialize(
        map_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("key")), ["doc_id", "key"], _signer(shingle, bands, rows), "doc_id long, key long, n_shingles long, cls binary, bands array<long>, sig array<long>"), "minhash"
    )
    # ``key`` names a text of the class, one of its smallest doc_id if it has any.
    text_of = F.coalesce(F.min_by("key", "doc_id"), F.min("key")).alias("key")
    classes = materialize(
        signed.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), text_of, F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "minhash-classes"
    )

    # Buckets with two classes or more, each row with its bucket's smallest class as hub.
    slots = classes.select("cls", F.posexplode("bands").alias("band", "key"))
    hubs = slots.groupBy("band", "key").agg(F.min("cls").alias("hub"), F.max("cls").alias("last")).where("hub <> last").select("band", "key", "hub")
    buckets = materialize(slots.join(hubs, ["band", "key"]), "minhash-buckets")

    def texts_of(wanted: DataFrame) -> DataFrame:
        """A text of every wanted class, and no text of another class."""
        need = wanted.join(classes.select("cls", "doc_id", "key"), "cls").select(F.col("doc_id").alias("id"), F.col("key").alias("k"))
        return docs.select("doc_id", "text").join(need, F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("k")), "left_semi").select("text")

    star = _star(buckets.where("cls <> hub"))
    pairs = materialize(star.join(classes.select(*_side("b", longs)), "b").join(classes.select(*_side("a", longs)), "a").where(_near(width, percent)).select("a", "b"), "star-pairs")
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    sets = materialize(texts_of(ends).mapInPandas(_set_reader(shingle), "cls binary, items array<long>").dropDuplicates(["cls"]), "star-sets")
    roots = components(_confirm(pairs, sets, percent, "star"), "star")

    # Second round: members of buckets that still hold several components.
    placed = buckets.join(roots, "cls", "left").select("band", "key", "cls", F.coalesce("root", "cls").alias("root"))
    open_ = placed.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("band", "key")
    still = materialize(placed.join(open_, ["band", "key"], "left_semi").select("cls", "root").distinct(), "minhash-open")
    named = classes.select("cls", "doc_id").join(roots, "cls", "left").select("cls", "doc_id", F.coalesce("root", "cls").alias("root"))
    for tops in _join_open(texts_of(still.select("cls")), still.join(classes.select("cls", "n"), "cls"), shingle, percent):
        named = named.join(tops, "root", "left").select("cls", "doc_id", F.coalesce("top", "root").alias("root"))

    ids = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_class = named.join(ids, "root").select("cls", "root", "component_id")
    out = signed.select("doc_id", "key", "n_shingles", "cls").join(by_class, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "key", "n_shingles", "root", component.alias("component_id"))
