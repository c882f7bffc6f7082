"""Quality gates on predictions, and the samples they use."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eraloom.functions.scalars import invalid_number
from eraloom.operators.errors import DriftGuardError
from eraloom.operators.metrics import correlation

BATCH = 200


@dataclass(frozen=True)
class GateLimits:
    min_pred_std: float = 1e-6
    max_abs_exposure: float = 0.30
    sample_rows: int | None = None  # exposures over all rows unless a caller asks for a sample
    sample_seed: int = 0


#: Rows that one task may order to break off a sample, and hexadecimal digits of the hash that one count tells apart.
ORDERED, DIGITS = 10_000, 4


def sample_rows(df: DataFrame, n: int, seed: int = 0, id_col: str = "id") -> DataFrame:
    """n rows without replacement in the order of a seeded hash of the id: the same rows under any partitioning.

    Nothing is sorted: counts of hash prefixes (65,536 at most) tell the prefix at which n is reached;
    all rows under it are in, and of the prefix itself only the rest that is wanted is
    ordered, after as many further digits as make that rest small. Rows that share a whole hash,
    repeats of an id, are as good as each other.
    """
    if n <= 0:
        return df.limit(0)
    key = F.sha2(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")), 256)
    keys, prefix, left = df.select(key.alias("k")), "", n
    while True:
        counts = keys.where(F.col("k").startswith(prefix)).groupBy(F.substring("k", 1, len(prefix) + DIGITS).alias("p")).count()
        for p, count in sorted(tuple(r) for r in counts.collect()):
            if count > left:
                prefix = p
                break
            left -= count
        else:
            return df.where(key < prefix + "g") if prefix else df  # all rows are wanted
        if left <= ORDERED or len(prefix) >= 64:
            break
    rows = df.withColumn("__key", key)
    below = rows.where(F.col("__key") < prefix).drop("__key")
    edge = rows.where(F.col("__key").startswith(prefix))
    edge = edge.limit(left) if left > ORDERED else edge.orderBy("__key", id_col).limit(left)
    return below.union(edge.drop("__key"))


def choose_features(catalog: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n features by seeded hash order, sorted by name."""
    return catalog.orderBy(F.sha2(F.concat_ws(":", F.lit(seed), "feature"), 256), "feature").limit(n).orderBy("feature")


def exposures(df: DataFrame, features: list[str], prediction: str = "prediction") -> DataFrame:
    """(feature, exposure): correlation of every feature with the prediction over rows
    where neither is missing; null where one is constant. Wide tables go in batches."""
    out = None
    for k in range(0, len(features), BATCH):
        part = features[k : k + BATCH]
        ok = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & F.col(prediction).isNotNull() & ~F.isnan(prediction)
        pairs = df.select(*(F.when(ok(c), F.col(c).cast("double")).alias(f"f{j}") for j, c in enumerate(part)), *(F.when(ok(c), F.col(prediction).cast("double")).alias(f"p{j}") for j, c in enumerate(part)))
        row = pairs.agg(*(correlation(f"f{j}", f"p{j}").alias(c) for j, c in enumerate(part)))
        tall = row.unpivot([], part, "feature", "exposure")
        out = tall if out is None else out.union(tall)
    return out


def prediction_stats(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    return df.agg(F.min(prediction).alias("min"), F.max(prediction).alias("max"), F.stddev_pop(prediction).alias("std"))


def gate_report(df: DataFrame, features: list[str], limits: GateLimits = GateLimits(), transform: str = "rank_01", prediction: str = "prediction", id_col: str = "id") -> DataFrame:  # noqa: B008
    """(position, gate, value, bound, passed) in the order in which gates apply."""
    p = F.col(prediction)
    one = df.agg(
        F.coalesce(F.count_if(p.isNull() | invalid_number(p)), F.lit(0)).cast("double").alias("invalid"),
        F.max(F.abs(p)).cast("double").alias("largest"),
        F.count_if((p < F.lit(1e-6).cast("float")) | (p > F.lit(1 - 1e-6).cast("float"))).cast("double").alias("outside"),
        F.stddev_pop(p).alias("std"),
    )
    seen = df if limits.sample_rows is None else sample_rows(df, limits.sample_rows, limits.sample_seed, id_col)
    exposed = exposures(seen, features, prediction)
    exposure = exposed.agg(F.max(F.abs(F.when(~F.isnan("exposure"), F.col("exposure")))).alias("exposure"))
    wide = one.crossJoin(exposure)  # one row each
    gates = [
        ("invalid_numbers", F.col("invalid"), F.lit(0.0), F.col("invalid") == 0),
        ("all_zero", F.col("largest"), F.lit(1e-8), F.col("largest") > 1e-8),
        *([("rank_bounds", F.col("outside"), F.lit(0.0), F.col("outside") == 0)] if transform == "rank_01" else []),
        ("spread", F.col("std"), F.lit(limits.min_pred_std), F.col("std") >= limits.min_pred_std),
        ("exposure", F.col("exposure"), F.lit(limits.max_abs_exposure), F.col("exposure") <= limits.max_abs_exposure),
    ]
    rows = F.array(*(F.struct(F.lit(k).alias("position"), F.lit(n).alias("gate"), v.alias("value"), b.alias("bound"), F.coalesce(ok, F.lit(False)).alias("passed")) for k, (n, v, b, ok) in enumerate(gates, 1)))
    return wide.select(F.inline(rows))


def assert_gates(report: DataFrame) -> None:
    """Raise for the first gate that failed."""
    bad = report.where("not passed").orderBy("position").first()
    if bad is not None:
        raise DriftGuardError(f"gate {bad['gate']} failed: value {bad['value']}, bound {bad['bound']}")


def require_columns(df: DataFrame, required: list[str], what: str) -> None:
    if missing := [c for c in required if c not in df.columns]:
        raise DriftGuardError(f"{what} lacks columns {missing}")


def feature_shards(catalog: DataFrame, seeds: list[int], limit: int, master_seed: int = 0) -> DataFrame:
    """(seed, feature): each seed's features.

    Features in hash order are cut into one shard per seed, the last taking the
    rest; a shard under ``limit`` is topped up from the others by a hash of the
    seed; a limit of 0 or of all features gives every seed all of them. The
    catalog is one row per feature name.
    """
    n = len(seeds)
    order = Window.orderBy(F.sha2(F.concat_ws(":", F.lit(master_seed), "feature"), 256), "feature")
    names = catalog.select("feature").distinct()
    numbered = names.withColumn("rn", F.row_number().over(order) - 1).withColumn("total", F.count(F.lit(1)).over(Window.partitionBy()))
    size = F.greatest(F.floor(F.col("total") / n), F.lit(1))
    shards = numbered.withColumn("shard", F.least(F.floor(F.col("rn") / size), F.lit(n - 1)))
    each = shards.select("*", F.posexplode(F.array(*map(F.lit, seeds))).alias("k", "seed"))
    if limit <= 0:
        return each.select("seed", "feature")
    mine = F.col("shard") == F.col("k")
    turn = F.row_number().over(Window.partitionBy("seed").orderBy(F.desc(mine.cast("int")), F.sha2(F.concat_ws(":", "seed", "feature"), 256), "feature"))
    return each.withColumn("turn", turn).where((F.col("turn") <= limit) | (F.col("total") <= limit)).select("seed", "feature")
