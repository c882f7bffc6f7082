"""Alignment of benchmark tables to rows by id."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eraloom.operators.errors import AlignmentError, DriftGuardError

SAMPLE = 10


def bench_columns(bench: DataFrame, id_col: str = "id") -> list[str]:
    return [c for c in bench.columns if c != id_col]


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def null_ratios(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, null_ratio) of all columns in one pass."""
    wide = df.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns))
    return wide.unpivot([], columns, "column", "null_ratio")


def missing_ids(main: DataFrame, bench: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids of ``main`` without a benchmark row."""
    return main.select(F.col(id_col).cast("string").alias(id_col)).join(bench.select(F.col(id_col).cast("string").alias(id_col)), id_col, "left_anti")


def covered_rows(main: DataFrame, bench: DataFrame, id_col: str = "id") -> DataFrame:
    return main.withColumn(id_col, F.col(id_col).cast("string")).join(bench.select(F.col(id_col).cast("string").alias(id_col)), id_col, "left_semi")


def join_benchmarks(main: DataFrame, bench: DataFrame, id_col: str = "id", columns: list[str] | None = None) -> DataFrame:
    """Left join on ids as strings: float benchmark columns, zero where not covered,
    and ``bench_present``. Checks nothing; see ``align_benchmarks``."""
    columns = bench_columns(bench, id_col) if columns is None else columns
    right = bench.select(F.col(id_col).cast("string").alias("__id"), *columns, F.lit(True).alias("__there"))
    both = main.withColumn(id_col, F.col(id_col).cast("string")).join(right, F.col(id_col) == F.col("__id"), "left")
    present = F.coalesce(F.col("__there"), F.lit(False))
    # Nulls on covered rows must stay visible, so only uncovered rows are filled.
    filled = (F.when(present, F.col(c)).otherwise(F.lit(0.0)).cast("float").alias(c) for c in columns)
    return both.select(*main.columns, *filled, present.alias("bench_present"))


@dataclass
class Alignment:
    rows: DataFrame
    columns: list[str]
    dropped: list[str]


def align_benchmarks(
    main: DataFrame, bench: DataFrame, id_col: str = "id", *, allow_partial: bool = False, drop_sparse: bool = True, max_null_ratio: float = 0.0, min_columns: int = 1
) -> Alignment:
    """Checked alignment. Errors: bad arguments or empty inputs, repeated ids,
    missing ids unless partial coverage is allowed, no covered row, too few
    columns after dropping sparse ones, nulls left on covered rows."""
    if not 0 <= max_null_ratio <= 1:
        raise AlignmentError("max_null_ratio must lie in [0, 1]")
    if min_columns <= 0:
        raise AlignmentError("min_columns must be positive")
    for name, df in (("main", main), ("benchmark", bench)):
        if id_col not in df.columns:
            raise AlignmentError(f"{name} rows lack column {id_col}")
    if main.isEmpty() or bench.isEmpty():
        raise AlignmentError("main rows or benchmark rows are empty")
    text_id = bench.select(F.col(id_col).cast("string").alias(id_col))
    repeated = duplicate_keys(text_id, [id_col])
    if n := repeated.count():
        raise AlignmentError(f"benchmark ids repeat: duplicate_count={n}")
    if not allow_partial:
        missing = missing_ids(main, bench, id_col)
        if n := missing.count():
            sample = [r[0] for r in missing.orderBy(id_col).limit(SAMPLE).collect()]
            raise AlignmentError(f"benchmark ids are missing: missing_count={n} sample={sample}")
    columns = bench_columns(bench, id_col)
    joined = join_benchmarks(main, bench, id_col)
    covered = joined.where("bench_present")
    ratios = covered.agg(F.count(F.lit(1)).alias("n"), *(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns)).first()
    if not ratios["n"]:
        raise AlignmentError("no row is covered by benchmarks")
    dropped = [c for c in columns if drop_sparse and ratios[c] > max_null_ratio]
    kept = [c for c in columns if c not in dropped]
    if len(kept) < min_columns:
        raise AlignmentError(f"dropping sparse columns removed too many columns: {len(kept)} left, {min_columns} needed")
    holes = covered.where(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in kept)))
    if any(ratios[c] > 0 for c in kept):
        sample = [r[0] for r in holes.select(id_col).orderBy(id_col).limit(SAMPLE).collect()]
        raise AlignmentError(f"benchmark nulls remain: rows={holes.count()} sample={sample}")
    return Alignment(joined.drop(*dropped), kept, dropped)


def align_live(live: DataFrame, bench: DataFrame, columns: list[str], id_col: str = "id") -> Alignment:
    """Strict alignment for live rows: every id present once, columns that are not
    numeric throughout are dropped, no nulls in the rest."""
    if not columns:
        raise DriftGuardError("no benchmark columns are configured")
    if missing := [c for c in columns if c not in bench.columns]:
        raise DriftGuardError(f"benchmark columns are missing: {missing}")
    if n := duplicate_keys(bench.select(F.col(id_col).cast("string").alias(id_col)), [id_col]).count():
        raise DriftGuardError(f"benchmark ids repeat: duplicate_count={n}")
    if n := missing_ids(live, bench, id_col).count():
        raise DriftGuardError(f"benchmark ids are missing: missing_count={n}")
    bad = bench.agg(*(F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull()).alias(c) for c in columns)).first()
    kept = [c for c in columns if not bad[c]]
    if not kept:
        raise DriftGuardError("no numeric benchmark column is left")
    numeric = bench.select(id_col, *(F.col(c).cast("string").try_cast("double").alias(c) for c in kept))
    rows = join_benchmarks(live, numeric, id_col)
    if nulls := rows.where(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in kept))).count():
        raise DriftGuardError(f"benchmark nulls in {nulls} live rows")
    return Alignment(rows, kept, [c for c in columns if c not in kept])


def union_splits(train: DataFrame, valid: DataFrame) -> DataFrame:
    """Bag union with a ``split`` column."""
    return train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("validation")))


def union_benchmarks(train: DataFrame, valid: DataFrame) -> DataFrame:
    """Bag union of tables with equal schemas; ids in both surface as repeated ids later."""
    if [(f.name, f.dataType) for f in train.schema] != [(f.name, f.dataType) for f in valid.schema]:
        raise AlignmentError("benchmark tables differ in schema")
    return train.union(valid)


def align_splits(train: DataFrame, valid: DataFrame, bench_train: DataFrame, bench_valid: DataFrame, id_col: str = "id", **limits) -> dict[str, Alignment]:
    """Train (partial coverage allowed), validation (full) and all rows together;
    they must agree on the kept columns. All checks come from one profile of all tables (``profile_splits``)."""
    columns = bench_columns(bench_train, id_col)
    kept = check_splits(profile_splits(train, valid, bench_train, bench_valid, id_col), columns, **limits)
    dropped = [c for c in columns if c not in kept]
    pairs = {"train": (train, bench_train), "validation": (valid, bench_valid), "all": (union_splits(train, valid), union_benchmarks(bench_train, bench_valid))}
    return {name: Alignment(join_benchmarks(main, bench, id_col, kept), kept, dropped) for name, (main, bench) in pairs.items()}


def profile_splits(train: DataFrame, valid: DataFrame, bench_train: DataFrame, bench_valid: DataFrame, id_col: str = "id") -> DataFrame:
    """One row for each of train, validation and all: rows, covered and missing ones, coverage, the null
    share of every benchmark column over covered rows, and repeated benchmark ids.

    Every table is read once: both benchmark tables become one row per id with its number in each
    split, one join covers all rows, and GROUPING SETS add up each split and the whole. A
    split's rows look only at its own benchmarks, the whole at both.
    """
    columns = bench_columns(bench_train, id_col)
    union_benchmarks(bench_train, bench_valid)  # equal schemas
    both = bench_train.withColumn("__own", F.lit("train")).union(bench_valid.withColumn("__own", F.lit("validation")))
    own = {s: F.col("__own") == s for s in ("train", "validation")}
    ids = both.groupBy(F.col(id_col).cast("string").alias("__id")).agg(
        *(F.count_if(is_own).alias(f"__n_{s}") for s, is_own in own.items()),
        *(F.max(F.when(is_own, F.col(c).isNull())).alias(f"__{c}_{s}") for c in columns for s, is_own in own.items()),
    )
    main = union_splits(train.select(F.col(id_col).cast("string").alias("__main")), valid.select(F.col(id_col).cast("string").alias("__main")))
    rows = main.join(ids, F.col("__main") == F.col("__id"), "full")
    # A benchmark id without a row still counts where it repeats; it belongs to the split that holds it.
    seen = F.coalesce("split", F.when(F.col("__n_train") > 0, "train").otherwise("validation"))
    n = {s: F.coalesce(f"__n_{s}", F.lit(0)) for s in own}
    mine = F.when(F.col("split") == "train", n["train"]).when(F.col("split") == "validation", n["validation"])
    null = lambda c, s: F.coalesce(F.col(f"__{c}_{s}"), F.lit(False))
    mine_null = lambda c: F.when(F.col("split") == "train", null(c, "train")).otherwise(null(c, "validation"))
    flat = rows.select(
        seen.alias("split"), F.col("split").isNotNull().alias("row"), (mine > 0).alias("own"), (n["train"] + n["validation"] > 0).alias("any"),
        F.when(seen == "train", n["train"] > 1).otherwise(n["validation"] > 1).alias("twice"), (n["train"] + n["validation"] > 1).alias("twice_any"),
        *(mine_null(c).alias(f"own_{c}") for c in columns), *((null(c, "train") | null(c, "validation")).alias(f"any_{c}") for c in columns),
    )
    each = F.grouping("split") == 0
    row = F.col("row")
    covered = F.when(each, F.count_if(row & F.col("own"))).otherwise(F.count_if(row & F.col("any")))
    nulls = [F.try_divide(F.when(each, F.count_if(row & F.col("own") & F.col(f"own_{c}"))).otherwise(F.count_if(row & F.col("any") & F.col(f"any_{c}"))), covered).alias(f"null_ratio_{c}") for c in columns]
    out = flat.groupingSets([["split"], []], "split").agg(
        F.count_if(row).alias("n_rows"), covered.alias("n_covered"), F.when(each, F.count_if("twice")).otherwise(F.count_if("twice_any")).alias("n_repeated"), *nulls
    )
    return out.select(F.coalesce("split", F.lit("all")).alias("split"), "n_rows", "n_covered", (F.col("n_rows") - F.col("n_covered")).alias("n_missing"), F.try_divide("n_covered", "n_rows").alias("coverage"), "n_repeated", *(f"null_ratio_{c}" for c in columns))


def check_splits(profile: DataFrame, columns: list[str], max_null_ratio: float = 0.0, min_columns: int = 1) -> list[str]:
    """The benchmark columns that train, validation and all keep alike, from their three profile rows. Errors as in
    ``align_benchmarks``: repeated ids, validation rows without benchmarks, a split that is not covered, too few columns,
    nulls left, columns that differ between splits."""
    kept = {}
    for r in profile.collect():  # three rows
        name = r["split"]
        if not r["n_rows"]:
            raise AlignmentError(f"{name} rows are empty")
        if r["n_repeated"]:
            raise AlignmentError(f"benchmark ids repeat in {name}: duplicate_count={r['n_repeated']}")
        if name == "validation" and r["n_missing"]:
            raise AlignmentError(f"benchmark ids are missing: missing_count={r['n_missing']}")
        if not r["n_covered"]:
            raise AlignmentError(f"no row of {name} is covered by benchmarks")
        kept[name] = [c for c in columns if r[f"null_ratio_{c}"] <= max_null_ratio]
        if len(kept[name]) < min_columns:
            raise AlignmentError(f"dropping sparse columns removed too many columns: {len(kept[name])} left, {min_columns} needed")
        if any(r[f"null_ratio_{c}"] > 0 for c in kept[name]):
            raise AlignmentError(f"benchmark nulls remain in {name}")
    if len(set(map(tuple, kept.values()))) > 1:
        raise AlignmentError(f"splits kept different columns: {kept}")
    return kept["all"]


def coverage(rows: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    return rows.groupBy(*by).agg(F.avg(F.col("bench_present").cast("double")).alias("coverage"), F.count(F.lit(1)).alias("n_rows"))
