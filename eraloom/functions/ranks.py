"""Ranks within groups, and the transforms built on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eraloom.functions.scalars import norm_ppf, norm_tail
from eraloom.plans.scratch import broadcast_if_small, materialize


def average_rank(value: str, by: list[str]) -> Column:
    """Rank from 1 with ties averaged; one sort serves it. A group with a NaN is all NaN."""
    upto = Window.partitionBy(*by).orderBy(value)
    rank = (F.rank().over(upto) + F.count(F.lit(1)).over(upto.rangeBetween(Window.unboundedPreceding, Window.currentRow))) / 2
    broken = F.max(F.isnan(value).cast("int")).over(Window.partitionBy(*by)) == 1
    return F.when(F.coalesce(broken, F.lit(False)), F.lit(float("nan"))).otherwise(rank)


def group_size(by: list[str]) -> Column:
    return F.count(F.lit(1)).over(Window.partitionBy(*by))


def rank_01(value: str, by: list[str]) -> Column:
    """Average rank as a share of the group, inside (0, 1)."""
    return (average_rank(value, by) - 0.5) / group_size(by)


def gauss_ranks(df: DataFrame, values: list[str], by: list[str], prefix: str = "g_", by_range: bool = False, row: str | None = None) -> DataFrame:
    """Normal quantile of each column's average rank, ``g_<value>``, under one exchange on ``by``;
    ``by_range`` ranks groups that are too large for one task by ``shares_by_range``, with ``row`` as there.

    The share and the quantile's tail variable are columns of their own, so that the
    polynomials read them instead of repeating the ranks.
    """
    shares = shares_by_range(df, values, by, row) if by_range else df.select("*", *(rank_01(v, by).alias(f"__u_{v}") for v in values))
    tails = shares.select("*", *(norm_tail(F.col(f"__u_{v}")).alias(f"__r_{v}") for v in values))
    share, tail = (lambda v: F.col(f"__u_{v}")), (lambda v: F.col(f"__r_{v}"))
    return tails.select(*(c for c in df.columns if c != row), *(F.when(F.isnan(share(v)), share(v)).otherwise(norm_ppf(share(v), tail(v))).alias(f"{prefix}{v}") for v in values))


def center(value: str, by: list[str]) -> Column:
    return F.col(value) - F.avg(value).over(Window.partitionBy(*by))


def centered(df: DataFrame, value: str, by: list[str], out: str, by_range: bool = False) -> DataFrame:
    """``center`` as a column of ``df``; ``by_range`` joins the groups' means instead of gathering groups."""
    if not by_range:
        return df.withColumn(out, center(value, by))
    means = materialize(df.groupBy(*(F.col(c).alias(f"__{c}") for c in by)).agg(F.avg(value).alias("__mean")), "group-means")
    means = broadcast_if_small(means, means.count(), GROUPS)
    return df.join(means, _same(by, df), "left").select(*df.columns, (F.col(value) - F.col("__mean")).alias(out))


#: Groups, or pieces of groups in ranges, that are broadcast at most; a shuffled join serves beyond.
GROUPS = 200_000
#: Shares that rows of one value may be dealt to.
SALTS = 64


def _same(by: list[str], df: DataFrame) -> Column:
    """Whether a row belongs to the group named by the columns ``__<by>``."""
    return reduce(lambda a, b: a & b, (df[c].eqNullSafe(F.col(f"__{c}")) for c in by))


def _ranks_in_ranges(rows: DataFrame, value: str, by: list[str], number: str = "__row") -> DataFrame:
    """``rows``, which are numbered by __row (or by ``number``, which is left out then), with __rank, __size and __broken: the average rank in the group, its rows, and whether it holds a NaN.

    Rows are dealt by range of (group, value, salt), so that neither a group nor a
    single value has to fit a task. A range ranks its own rows; rows of the group in earlier
    ranges shift them. Only the first and the last value of a group's piece in a range can go on in
    other ranges, so these are counted again over all pieces that begin or end with
    them. Pieces are one row for each range and group.
    """
    salt = F.pmod(F.xxhash64(number), F.lit(SALTS))
    dealt = rows.withColumn("__salt", salt).repartitionByRange(*by, value, "__salt").drop("__salt", *[number] * (number != "__row"))
    dealt = materialize(dealt.withColumn("__range", F.spark_partition_id()), "ranges")
    piece = ["__range", *by]
    v = F.col(value)
    nan = F.max(F.coalesce(F.isnan(value), F.lit(False)))
    ends = F.struct(v.alias("v"))  # a struct, so that null is a value like others
    pieces = dealt.groupBy(*piece).agg(F.count(F.lit(1)).alias("n"), nan.alias("nan"), F.min(ends).alias("low"), F.max(ends).alias("high"))
    edge = dealt.join(_fit(pieces.select(*(F.col(c).alias(f"__{c}") for c in piece), "low", "high")), _same(piece, dealt))
    edge = edge.where(v.eqNullSafe(F.col("low.v")) | v.eqNullSafe(F.col("high.v"))).groupBy(*piece, v.alias("v")).agg(F.count(F.lit(1)).alias("m"))
    alike = Window.partitionBy(*by, "v")
    edge = edge.select(*piece, "v", F.sum("m").over(alike).alias("all"), F.coalesce(F.sum("m").over(alike.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    edge = edge.groupBy(*(F.col(c).alias(f"__{c}") for c in piece)).agg(F.collect_list(F.struct("v", "all", "earlier")).alias("edges"))  # two at most
    group = Window.partitionBy(*by)
    before = F.coalesce(F.sum("n").over(group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = pieces.select(*(F.col(c).alias(f"__{c}") for c in piece), before.alias("__before"), F.sum("n").over(group).alias("__size"), F.max("nan").over(group).alias("__broken"))
    same = reduce(lambda a, b: a & b, (F.col(f"p.__{c}").eqNullSafe(F.col(f"e.__{c}")) for c in piece))
    shifts = shifts.alias("p").join(edge.alias("e"), same).select("p.*", "edges")
    upto = Window.partitionBy(*piece).orderBy(value)
    less, equal = F.rank().over(upto) - 1, F.count(F.lit(1)).over(upto.rangeBetween(Window.currentRow, Window.currentRow))
    local = dealt.select("*", less.alias("__less"), equal.alias("__equal"))
    both = local.join(_fit(shifts), _same(piece, local))
    mine = F.get(F.filter("edges", lambda e: e["v"].eqNullSafe(v)), F.lit(0))
    smaller = F.col("__before") + F.col("__less") - F.coalesce(mine["earlier"], F.lit(0))
    rank = smaller + (F.coalesce(mine["all"], F.col("__equal")) + 1) / 2
    return both.select(*(c for c in dealt.columns if c != "__range"), F.when(F.col("__broken"), F.lit(float("nan"))).otherwise(rank).alias("__rank"), "__size")


def _fit(small: DataFrame) -> DataFrame:
    """A table of pieces, written and counted: broadcast if few, else left to a join on its range."""
    small = materialize(small, "range-pieces")
    return broadcast_if_small(small, small.count(), GROUPS)


def average_rank_by_range(df: DataFrame, value: str, by: list[str], out: str = "avg_rank", share: bool = False, row: str | None = None) -> DataFrame:
    """``average_rank`` (or ``rank_01``) for groups too large for one task, with equal results; ``row`` as in ``shares_by_range``."""
    rank = (F.col("__rank") - 0.5) / F.col("__size") if share else F.col("__rank")
    ranked = _ranks_in_ranges(df, value, by, row) if row else _ranks_in_ranges(_numbered(df), value, by)
    return ranked.select(*(c for c in df.columns if c != row), rank.alias(out))


def _numbered(df: DataFrame) -> DataFrame:
    """The rows written once with a number each, so that whatever is dealt anew after a loss is dealt alike."""
    return materialize(df.withColumn("__row", F.monotonically_increasing_id()), "range-rows")


def shares_by_range(df: DataFrame, values: list[str], by: list[str], row: str | None = None) -> DataFrame:
    """``rank_01`` of every value as ``__u_<value>``, for groups too large for one task.

    ``row`` names a column that numbers the rows of a group, where they are derived row by row
    from a written table: with one value they are not written again to be numbered. The column is left out.

    Several columns are dealt in one exchange: rows are numbered and unpivoted to (row, group,
    column, value), ranked within (group, column), and folded back by row.
    """
    if len(values) == 1:
        return average_rank_by_range(df, values[0], by, f"__u_{values[0]}", share=True, row=row)
    rows = _numbered(df.drop(row) if row else df)
    cells = F.array(*(F.struct(F.lit(k).alias("c"), F.col(v).cast("double").alias("v")) for k, v in enumerate(values)))
    long = rows.select("__row", *by, F.explode(cells).alias("cell")).select("__row", *by, F.col("cell.c").alias("__col"), F.col("cell.v").alias("__value"))
    ranked = _ranks_in_ranges(long, "__value", [*by, "__col"])
    share = (F.col("__rank") - 0.5) / F.col("__size")
    wide = ranked.groupBy("__row").agg(*(F.max(F.when(F.col("__col") == k, share)).alias(f"__u_{v}") for k, v in enumerate(values)))
    return rows.join(wide, "__row").drop("__row")
