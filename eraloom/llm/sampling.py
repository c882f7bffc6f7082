"""Bounded, repeatable samples of labelled rows for fitting on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; rows of fold 0 are never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def per_class(rows: DataFrame, label: str, want: int, by: list[str] = ["doc_id"]) -> DataFrame:  # noqa: B006
    """About ``want`` rows of each value of ``label``, chosen by a hash of the columns ``by``.

    A class's count gives its rate, so what is collected stays near
    ``want * classes`` however large the table is; the same rows come back
    under any partitioning.
    """
    counts = {r[label]: r["count"] for r in rows.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    drawn = F.pmod(F.xxhash64(*by, F.lit(17)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    rate = F.lit(0.0)
    for value, n in sorted(counts.items(), key=lambda x: str(x[0])):
        rate = F.when(F.col(label) == F.lit(value), F.lit(want / n)).otherwise(rate)
    return rows.where(drawn < rate)
