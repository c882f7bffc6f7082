"""Walk-forward windows over era numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eraloom.operators.metrics import era_corr


def build_windows(rows: DataFrame, chunk: int = 156, purge: int = 8, first_chunk: int = 2, era: str = "era_int") -> DataFrame:
    """Validation chunks with the training range before them.

    Chunk c validates ((c-1)*chunk, c*chunk] and trains up to ``purge`` eras before;
    a window needs at least one era on both sides, a partial last chunk is dropped,
    and ids count the windows kept. Works on distinct eras, so it stays small.
    """
    eras = rows.select(F.col(era).cast("int").alias("e")).where("e is not null").distinct()
    last = eras.agg(F.max("e").alias("top")).select(F.floor(F.col("top") / chunk).cast("int").alias("chunks")).where(F.col("chunks") >= first_chunk)
    w = last.select(F.explode(F.sequence(F.lit(first_chunk), F.col("chunks"))).alias("c"))
    w = w.select("c", ((F.col("c") - 1) * chunk + 1).alias("val_start"), (F.col("c") * chunk).alias("val_end"))
    w = w.withColumn("train_end", F.col("val_start") - purge - 1)
    first = eras.agg(F.min("e").alias("train_start"))
    w = w.crossJoin(F.broadcast(first)).where("train_start <= train_end")  # one row
    filled = eras.select(F.ceil(F.col("e") / chunk).cast("int").alias("c")).distinct()
    w = w.join(filled, "c", "left_semi")
    return w.select(
        F.row_number().over(Window.orderBy("c")).alias("window_id"),
        "train_start",
        "train_end",
        (F.col("train_end") + 1).alias("purge_start"),
        (F.col("val_start") - 1).alias("purge_end"),
        "val_start",
        "val_end",
    )


def last_windows(windows: DataFrame, n: int) -> DataFrame:
    """The last n windows, ids unchanged."""
    return windows.orderBy(F.desc("window_id")).limit(n)


def validation_rows(rows: DataFrame, windows: DataFrame, chunk: int = 156, era: str = "era_int") -> DataFrame:
    """Rows with the window they validate. Chunks do not overlap, so the range
    condition is an equi-join on the chunk number."""
    keyed = windows.select("window_id", F.ceil(F.col("val_end") / chunk).alias("__chunk"))
    return rows.withColumn("__chunk", F.ceil(F.col(era) / chunk)).join(keyed, "__chunk").drop("__chunk")


def train_rows(rows: DataFrame, train_end: int, era: str = "era_int") -> DataFrame:
    return rows.where(F.col(era) <= train_end)


def expanding_fits(rows: DataFrame, windows: DataFrame, y: str, xs: list[str], era: str = "era_int") -> DataFrame:
    """(window_id, n, intercept, beta): least squares of y on [1, xs] over each window's training range.

    Training ranges contain each other, so a row is read once: it belongs to the first
    window whose range holds it, moments are summed per window, and running sums over the windows give
    the moments of the whole ranges. Windows are few and broadcast. Rows with a missing value take no part.
    """
    from eraloom.operators.neutralize import solve_moments

    spans = windows.select("window_id", F.col("train_start").alias("__start"), F.col("train_end").alias("__end"), F.coalesce(F.lag("train_end").over(Window.orderBy("window_id")), F.col("train_start") - 1).alias("__before"))
    whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in [y, *xs]))
    mine = rows.where(whole).select(era, *(F.col(c).cast("double").alias(c) for c in [y, *xs])).join(F.broadcast(spans), (F.col(era) > F.col("__before")) & (F.col(era) <= F.col("__end")) & (F.col(era) >= F.col("__start")))
    terms = [y, *xs]
    products = [(a, b) for i, a in enumerate(terms) for b in terms[i:]]
    sums = mine.groupBy("window_id").agg(F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(f"s_{c}") for c in terms), *(F.sum(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for a, b in products))
    sums = windows.select("window_id").join(sums, "window_id", "left")
    upto = Window.orderBy("window_id").rowsBetween(Window.unboundedPreceding, 0)
    names = ["n", *(f"s_{c}" for c in terms), *(f"p_{a}_{b}" for a, b in products)]
    run = sums.select("window_id", *(F.coalesce(F.sum(c).over(upto), F.lit(0)).cast("double").alias(c) for c in names)).where("n > 0")
    mean = lambda c: F.col(f"s_{c}") / F.col("n")
    cov = lambda a, b: F.col(f"p_{a}_{b}") / F.col("n") - mean(a) * mean(b)
    moments = F.array(mean(y), cov(y, y), *(mean(x) for x in xs), *(cov(y, x) for x in xs), *(cov(a, b) for i, a in enumerate(xs) for b in xs[i:]))
    fits = solve_moments(run.select("window_id", F.col("n").cast("long").alias("n"), moments.alias("moments")), xs)
    return fits.select("window_id", "n", "intercept", "beta")


def window_coverage(rows: DataFrame, min_rows: int = 512, min_eras: int = 8, era: str = "era_int") -> DataFrame:
    """Covered rows and eras of each window, and why a window is skipped."""
    covered = F.col("bench_present")
    counts = rows.groupBy("window_id").agg(F.count_if(covered).alias("covered_rows"), F.countDistinct(F.when(covered, F.col(era))).alias("covered_eras"))
    reason = F.when(F.col("covered_rows") < min_rows, "rows").when(F.col("covered_eras") < min_eras, "eras").otherwise("ok")
    return counts.withColumn("reason", reason)


def window_corr(rows: DataFrame, era: str = "era_int") -> DataFrame:
    """Mean CORR of each window over its eras."""
    return era_corr(rows, ["window_id", era]).groupBy("window_id").agg(F.avg("corr").alias("corr"))


def summarize(report: DataFrame) -> DataFrame:
    """Mean, population deviation, Sharpe (0 without deviation), hit rate and median
    iterations of window rows (corr, best_iter)."""
    s = report.agg(F.avg("corr").alias("mean_corr"), F.stddev_pop("corr").alias("std_corr"), F.avg((F.col("corr") > 0).cast("double")).alias("hit_rate"), F.median("best_iter").cast("int").alias("recommended_iters"))
    return s.withColumn("sharpe", F.when(F.col("std_corr") == 0, F.lit(0.0)).otherwise(F.try_divide("mean_corr", "std_corr")))
