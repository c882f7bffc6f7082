"""Continuous history ingestion from snapshot files, as a log of segments that is merged in tiers.

A micro-batch b writes its own rows, one per key, as ``segment-b-b`` and reads nothing of the
history. When b + 1 is a multiple of a power of ``fan``, the segments of that many batches
are merged into one that spans them; a row is so rewritten once for each tier, about log(b) times in all,
and the state is a few segments at any time. A segment counts once its write has
succeeded (Parquet's ``_SUCCESS`` file is the commit mark), so a failed write or merge leaves
the segments before it in force. Segments that an earlier merge has covered are removed at the next
merge, which leaves time to readers that have begun.

Of the rows of a key the largest ``ingest_seq`` counts, whatever batch brings it and
in whatever order batches come: the result is ``keep_last`` of all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eraloom.operators.history import KEY, keep_last
from eraloom.plans.scratch import folders, remove

Span = tuple[int, int]


def merge_span(batch_id: int, fan: int) -> Span | None:
    """The batches that are merged after a batch: the largest power of ``fan`` that divides its number from 1."""
    size = 1
    while (batch_id + 1) % (size * fan) == 0:
        size *= fan
    return (batch_id + 1 - size, batch_id) if size > 1 else None


def segments(spark: SparkSession, target: str) -> list[Span]:
    """Spans of the written segments."""
    found = []
    for name, whole in folders(spark, target):
        if whole and name.startswith("segment-"):
            low, high = name.removeprefix("segment-").split("-")
            found.append((int(low), int(high)))
    return sorted(found)


def cover(spans: list[Span], low: int = 0, high: int | None = None) -> list[Span]:
    """The longest segments, one after another, from batch ``low`` on; ``high`` bounds them to parts of a merge."""
    out, whole = [], (low, high)
    while True:
        fitting = [s for s in spans if s[0] == low and s != whole and (high is None or s[1] <= high)]
        if not fitting:
            return out
        out.append(max(fitting, key=lambda s: s[1]))
        low = out[-1][1] + 1


def _read(spark: SparkSession, target: str, spans: list[Span]) -> DataFrame:
    return spark.read.parquet(*(f"{target}/segment-{low}-{high}" for low, high in spans))


def ingest(
    spark: SparkSession, folder: str, schema: str, target: str, normalize: Callable[[DataFrame], DataFrame], keys: list[str] = KEY, fmt: str = "parquet", once: bool = True, fan: int = 16, files_per_batch: int | None = None
) -> StreamingQuery:
    """Merge every new file of ``folder`` into the history under ``target``.

    A replayed batch writes the same segments again. The stream's checkpoint lies beside them, so
    that a restarted stream goes on with the next number and only with files it has not seen.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        keep_last(normalize(batch), "ingest_seq", keys).write.mode("overwrite").parquet(f"{target}/segment-{batch_id}-{batch_id}")
        span = merge_span(batch_id, fan)
        if span is None:
            return
        there = segments(spark, target)
        parts = cover(there, *span)
        keep_last(_read(spark, target, parts), "ingest_seq", keys).write.mode("overwrite").parquet(f"{target}/segment-{span[0]}-{span[1]}")
        for low, high in there:
            if any(a <= low and high <= b and (a, b) != (low, high) for a, b in there if (a, b) != span):
                remove(spark, f"{target}/segment-{low}-{high}")

    reader = spark.readStream.schema(schema).format(fmt)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader
    writer = reader.load(folder).writeStream.foreachBatch(merge).option("checkpointLocation", f"{target}/_checkpoint")
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest_version(spark: SparkSession, target: str, keys: list[str] = KEY) -> DataFrame:
    """The merged history of all batches so far."""
    return keep_last(_read(spark, target, cover(segments(spark, target))), "ingest_seq", keys)
