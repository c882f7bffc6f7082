"""Fitted trees as node arrays, evaluated for a whole ensemble in one pass over the rows.

An ensemble is flattened once and sent once; a task walks all rows of a batch through a
tree at a time and keeps running sums, so a pass costs the same number of jobs whatever the number of
trees, and nothing but what is asked for leaves it: a squared error per round and task, or
sums at chosen rounds. Only the features' columns are read; no feature vector is written.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LINE = re.compile(r"(If|Else) \(feature (\d+) (<=|>) (\S+)\)|Predict: (\S+)")


@dataclass(frozen=True)
class FlatTree:
    """Nodes in preorder: the feature asked (-1 in a leaf), its threshold, both children, the leaf's value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def values(self, x: np.ndarray) -> np.ndarray:
        """The leaf value of every row; a missing number goes right, as in Spark's trees."""
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while True:
            asked = self.feature[at]
            inner = asked >= 0
            if not inner.any():
                return self.value[at]
            lower = x[rows, asked] <= self.threshold[at]
            at = np.where(inner, np.where(lower, self.left[at], self.right[at]), at)


def flatten(model, names: Sequence[int] | None = None) -> FlatTree:
    """Node arrays of a fitted Spark tree; ``names`` gives the number in the whole feature list of each of its features."""
    nodes: list[list[float]] = []

    def add(lines: Iterator[tuple]) -> int:
        word, feature, _, threshold, value = next(lines)
        me = len(nodes)
        if value:
            nodes.append([-1, 0.0, 0, 0, float(value)])
            return me
        if word != "If":
            raise ValueError("not a regression tree over numbers")
        nodes.append([int(feature), float(threshold), 0, 0, 0.0])
        nodes[me][2] = add(lines)
        if next(lines)[0] != "Else":
            raise ValueError("not a regression tree over numbers")
        nodes[me][3] = add(lines)
        return me

    text = model.toDebugString
    if re.search(r"\(feature \d+ (not )?in ", text):
        raise ValueError("trees over categories are not flattened")
    add(iter(_LINE.findall(text)))
    feature, threshold, left, right, value = zip(*nodes, strict=True)
    numbers = np.array(feature, np.int64)
    if names is not None:
        numbers = np.where(numbers >= 0, np.array(names, np.int64)[numbers], -1)
    return FlatTree(numbers, np.array(threshold), np.array(left), np.array(right), np.array(value))


@dataclass
class Ensemble:
    """Trees (anything with ``values``) and their weights; ``errors`` are (round, validation error) where a fit has seen them."""

    trees: list = field(default_factory=list)
    treeWeights: list[float] = field(default_factory=list)  # noqa: N815  Spark's name
    errors: list[tuple[int, float]] | None = None

    def first(self, n: int) -> Ensemble:
        return Ensemble(self.trees[:n], self.treeWeights[:n])


def as_ensemble(model) -> Ensemble:
    """A model with node arrays: an ensemble of Spark's, of this module, or a single tree."""
    if isinstance(model, Ensemble):
        return model
    trees = model.trees if hasattr(model, "trees") else [model]
    weights = list(model.treeWeights) if hasattr(model, "trees") else [1.0]
    return Ensemble([t if hasattr(t, "values") else flatten(t) for t in trees], weights)


def matrix(batch: pa.RecordBatch, features: list[str]) -> np.ndarray:
    """The features as one matrix of doubles, null as NaN."""
    return np.column_stack([batch.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features])


def _sent(df: DataFrame, model: Ensemble):
    return df.sparkSession.sparkContext.broadcast((model.trees, model.treeWeights))


def staged_errors(df: DataFrame, model: Ensemble, features: list[str], target: str = "target", start: str | None = None) -> DataFrame:
    """(iter, rmse) after every tree, in one pass; sums begin at the column ``start`` or at 0. Rows without a target count nowhere."""
    sent = _sent(df, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, weights = sent.value
        square, n = np.zeros(len(trees)), 0
        for batch in batches:
            y = batch.column(target).cast(pa.float64()).to_numpy(zero_copy_only=False)
            known = np.asarray(batch.column(target).is_valid())
            x, total = matrix(batch, features), np.zeros(len(y)) if start is None else batch.column(start).to_numpy(zero_copy_only=False).copy()
            n += int(known.sum())
            for k, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
                total += weight * tree.values(x)
                square[k] += ((total - y)[known] ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(1, len(trees) + 1), pa.int32()), pa.array([n] * len(trees), pa.int64()), pa.array(square)], ["iter", "n", "square"])

    columns = list(dict.fromkeys([*features, target, *([start] if start else [])]))
    parts = df.select(*columns).mapInArrow(run, "iter int, n long, square double")
    return parts.groupBy("iter").agg(F.sqrt(F.try_divide(F.sum("square"), F.sum("n"))).alias("rmse"))


def staged_at(df: DataFrame, model: Ensemble, features: list[str], points: list[int], keep: list[str], start: str | None = None, out: str = "sums") -> DataFrame:
    """``keep`` and an array of the sums at ``points`` (numbers of trees, ascending), in one pass."""
    sent, wanted = _sent(df, model.first(max(points))), set(points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, weights = sent.value
        for batch in batches:
            x = matrix(batch, features)
            total = np.zeros(len(x)) if start is None else batch.column(start).to_numpy(zero_copy_only=False).copy()
            sums = np.empty((len(x), len(points)))
            at = 0
            for k, (tree, weight) in enumerate(zip(trees, weights, strict=True), 1):
                total += weight * tree.values(x)
                if k in wanted:
                    sums[:, at] = total
                    at += 1
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(points), pa.int32()), pa.array(sums.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists], [*keep, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for c in keep for f in [df.schema[c]])
    columns = list(dict.fromkeys([*keep, *features, *([start] if start else [])]))
    return df.select(*columns).mapInArrow(run, f"{fields}, `{out}` array<double>")


def predict(df: DataFrame, model: Ensemble, features: list[str], out: str) -> DataFrame:
    """The rows with the ensemble's sum as ``out``."""
    rows = staged_at(df, model, features, [len(model.trees)], df.columns, out="__sums")
    return rows.select(*df.columns, F.get("__sums", F.lit(0)).alias(out))
