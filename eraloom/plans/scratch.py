"""Tables written to the folder that all executors share, to cut lineage safely."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: Paths of the tables that the innermost ``scratch_scope`` has seen written.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)

#: Spark's switch for removing a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_switch = threading.Lock()
_writers: dict[int, tuple[int, str]] = {}


@contextmanager
def _cleaning(spark: SparkSession) -> Iterator[None]:
    """The switch on while any thread writes, and as it was when the last one ends."""
    me = id(spark)
    with _switch:
        n, before = _writers.get(me, (0, ""))
        if not n:
            before = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        _writers[me] = (n + 1, before)
    try:
        yield
    finally:
        with _switch:
            n, before = _writers.pop(me)
            if n > 1:
                _writers[me] = (n - 1, before)
            else:
                spark.conf.set(_CLEANUP, before)


def side_by_side(spark: SparkSession, tasks: list[Callable[[], T]], at_once: int) -> list[T]:
    """Results of independent driver tasks in order, ``at_once`` of them at a time, each in a pool
    of its own for the FAIR scheduler; the first error is raised."""
    if at_once <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]

    def pooled(k: int, task: Callable[[], T]) -> T:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"side-{k}")
        return task()

    with ThreadPoolExecutor(max_workers=at_once) as threads:
        return [f.result() for f in [threads.submit(copy_context().run, inheritable_thread_target(spark)(pooled), k, t) for k, t in enumerate(tasks)]]


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where that is unset, a local session (tests) gets a temporary folder of its
    own; a cluster session raises, since executors share no local disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a cached or locally checkpointed frame it survives lost executors,
    and several readers cost one computation. Spark removes the write's own shuffle
    files at its end, so that disk holds one step's shuffles and not those of all.
    """
    return materialize_at(df, scratch_path(df.sparkSession, name))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system that nothing reads any more."""
    jvm = spark._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def folders(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Names of the folders in a folder of the shared file system, and whether a finished write has marked each."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]
    return [(p.getName(), fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))) for p in found]


def materialize_at(df: DataFrame, path: str) -> DataFrame:
    """``materialize`` at a path that the caller removes."""
    spark = df.sparkSession
    if (seen := _written.get()) is not None:
        seen.append(path)
    with _cleaning(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that are written inside go at the end, but for those of frames given to the
    yielded function: for a step whose result is itself written there, so that a finished
    step leaves its result and nothing else. A frame that still reads another of these tables must not outlive the scope."""
    paths: list[str] = []
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df.scratch_path)
        return df

    before = _written.set(paths)
    try:
        yield keep
    finally:
        _written.reset(before)
        if (outer := _written.get()) is not None:
            outer.extend(kept)
        for path in paths:
            if path not in kept:
                remove(spark, path)


def once(df: DataFrame) -> DataFrame:
    """``df`` with each row's columns computed once: the planner moves a filter on a column below
    the column and repeats the expression there for every mention, but not below a generator."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Hint a broadcast only when the counted ``rows`` stay under ``limit``;
    otherwise leave the choice of a shuffled join to the planner."""
    return F.broadcast(df) if rows <= limit else df
