"""Tables in versions: a failed write leaves the version before it readable.

``publish`` writes a new version beside the ones before; the format's ``_SUCCESS`` file, which the
write leaves last, is its commit mark. Readers take the newest marked version. Versions before
the last ``keep`` are removed after a commit, so readers that have begun keep their files for a while.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from eraloom.plans.scratch import folders, remove

PREFIX = "version-"


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and folder of every committed version, oldest first."""
    found = [name for name, whole in folders(spark, path) if whole and name.startswith(PREFIX)]
    return sorted((int(name.split("-")[1]), f"{path}/{name}") for name in found)


def publish(df: DataFrame, path: str, fmt: str = "parquet", keep: int = 2, **options: object) -> str:
    """Write the next version; two writers at a time make two folders, of which the later-named counts."""
    spark = df.sparkSession
    there = versions(spark, path)
    number = there[-1][0] + 1 if there else 0
    target = f"{path}/{PREFIX}{number:09d}-{uuid.uuid4().hex[:8]}"
    df.write.options(**options).format(fmt).save(target)
    for _, old in versions(spark, path)[:-keep]:
        remove(spark, old)
    return target


def current(spark: SparkSession, path: str) -> str:
    """Folder of the newest committed version."""
    there = versions(spark, path)
    if not there:
        raise AnalysisException(errorClass="PATH_NOT_FOUND", messageParameters={"path": path})
    return there[-1][1]
