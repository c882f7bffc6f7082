"""Vector code compression: product codes learned over anchors-hierarchy metric trees.

Every vector is cut into ``parts`` equal parts of integers floor(1024 * x), and each
part is replaced by the index of its nearest codebook entry. Codebooks start as the
parts of the smallest ids and move to the floored means of their parts, ``rounds`` times.

A chunk of at most ``CHUNK`` vectors gets one tree for each part position, built once
and written to the shared folder. Trees grow middle-out: about the square root of n
anchors steal points from each other (a point nearer its anchor than half the way to
the new one is not looked at), anchors are merged pairwise into ever larger balls, and
each anchor is divided again in the same way. A ball caches sum and count of its points.
A round goes down each tree with the list of entries that may be nearest to some
point of a ball: a ball inherits its parent's list and strikes an entry out when the
whole ball lies beyond the bisecting plane to a nearer entry. A ball with one entry left
is wholly owned, and its cached sum and count are added at once; a leaf compares
its points with its own list. Tests on balls leave room for rounding and points are
compared exactly, so the result equals that of comparing every part with every entry.

A round is one pass over the trees and returns one row per entry and task; only
sums per entry (``parts * entries`` rows) and the codebooks pass the driver. The task of
a chunk holds that chunk and its trees, whatever ids, labels or copies repeat.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components go, and
so do vectors whose length is no multiple of ``parts`` or differs from that of the
smallest kept id; ids may be null or repeat (the smallest rows by id, nulls last, then by
vector start the codebooks); with fewer rows than entries there are as many entries
as rows; components beyond 2**27 in size count as 2**27, so that an error is a long;
a label's error beyond a long is null; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eraloom.plans.scratch import broadcast_if_small, materialize

SCALE = 1024
#: Vectors of one chunk, and points of a ball that is divided no further.
CHUNK, LEAF = 8192, 192
#: Components are kept within this size; up to EXACT products of parts are exact as floating point.
LARGEST, EXACT = 1 << 27, 1 << 22
#: Labels that are broadcast at most, and shares that each label is dealt into beyond.
LABELS, SALTS = 10_000, 32


def _node(width: int) -> np.dtype:
    return np.dtype([("start", "i4"), ("end", "i4"), ("left", "i4"), ("right", "i4"), ("radius", "f8"), ("sum", "i8", (width,))])


def anchors(x: np.ndarray, k: int) -> list[np.ndarray]:
    """At most k groups of rows of x: each new anchor is the point farthest from its own, and takes what is nearer to it."""
    owner = np.zeros(len(x), np.int64)
    far = np.sqrt(((x - x[0]) ** 2).sum(1))
    pivots = [0]
    while len(pivots) < k:
        new = int(far.argmax())
        if far[new] == 0:
            break
        half = np.sqrt(((x[pivots] - x[new]) ** 2).sum(1)) / 2
        near = np.flatnonzero(far > half[owner])
        d = np.sqrt(((x[near] - x[new]) ** 2).sum(1))
        near, d = near[d < far[near]], d[d < far[near]]
        owner[near], far[near] = len(pivots), d
        pivots.append(new)
    order = np.argsort(owner, kind="stable")
    return [g for g in np.split(order, np.searchsorted(owner[order], np.arange(1, len(pivots)))) if len(g)]


def merge_order(centres: np.ndarray, counts: np.ndarray, radii: np.ndarray) -> list[tuple[int, int]]:
    """Pairs to merge, always the two whose common ball is smallest; the result of step i is number k + i."""
    k = len(centres)
    p, n, r = np.empty((2 * k - 1, centres.shape[1])), np.empty(2 * k - 1), np.empty(2 * k - 1)
    p[:k], n[:k], r[:k] = centres, counts, radii
    cost = np.full((2 * k - 1, 2 * k - 1), np.inf)

    def against(one: int, others: np.ndarray) -> np.ndarray:
        gap, share = np.sqrt(((p[others] - p[one]) ** 2).sum(1)), n[others] / (n[others] + n[one])
        return np.maximum(gap * share + r[one], gap * (1 - share) + r[others])

    for i in range(1, k):
        cost[i, :i] = against(i, np.arange(i))
    alive, out = list(range(k)), []
    for new in range(k, 2 * k - 1):
        a, b = divmod(int(cost[:new, :new].argmin()), new)
        out.append((a, b))
        n[new] = n[a] + n[b]
        p[new], r[new] = (p[a] * n[a] + p[b] * n[b]) / n[new], cost[a, b]
        cost[[a, b]] = cost[:, [a, b]] = np.inf
        alive = [i for i in alive if i not in (a, b)]
        if alive:
            cost[new, alive] = against(new, np.array(alive))
        alive.append(new)
    return out


def build_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points along the leaves, and the balls; the root is the last one."""
    x = points.astype(np.float64)
    order: list[np.ndarray] = []
    nodes: list[tuple] = []
    filled = 0

    def ball(rows: np.ndarray, start: int, left: int, right: int) -> int:
        total = points[rows].sum(0)
        radius = np.sqrt(((x[rows] - total / len(rows)) ** 2).sum(1).max())
        nodes.append((start, start + len(rows), left, right, radius, total))
        return len(nodes) - 1

    def grow(rows: np.ndarray) -> tuple[int, np.ndarray]:
        nonlocal filled
        groups = anchors(x[rows], max(2, int(len(rows) ** 0.5))) if len(rows) > LEAF else []
        if len(groups) < 2:
            order.append(rows)
            start, filled = filled, filled + len(rows)
            return ball(rows, start, -1, -1), rows
        groups = [rows[g] for g in groups]
        centres = np.array([x[g].mean(0) for g in groups])
        radii = np.array([np.sqrt(((x[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, centres, strict=True)])
        pairs, k = merge_order(centres, np.array([len(g) for g in groups]), radii), len(groups)

        def down(i: int) -> tuple[int, np.ndarray]:
            if i < k:
                return grow(groups[i])
            start = filled
            (a, some), (b, rest) = map(down, pairs[i - k])
            both = np.concatenate([some, rest])
            return ball(both, start, a, b), both

        return down(2 * k - 2)

    grow(np.arange(len(points)))
    return np.concatenate(order), np.array(nodes, _node(points.shape[1]))


def assign(points: np.ndarray, nodes: np.ndarray, book: np.ndarray, labels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sum and count of the points (in tree order) nearest to each entry; ``labels`` receives the entries."""
    m = len(book)
    sums, counts = np.zeros(book.shape, np.int64), np.zeros(m, np.int64)
    c = book.astype(np.float64)
    size = (c * c).sum(1)
    between = np.sqrt(np.maximum(size[:, None] - 2 * c @ c.T + size, 0))
    exact = np.float64 if max(np.abs(points).max(), np.abs(book).max()) <= EXACT else np.int64
    entries, spot = book.astype(exact), points.astype(exact)
    weight = (entries * entries).sum(1)
    centre = nodes["sum"] / (nodes["end"] - nodes["start"])[:, None]
    here, lists = np.array([len(nodes) - 1]), np.ones((1, m), bool)
    spots, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while len(here):
        p, r = centre[here], nodes["radius"][here]
        own = (p * p).sum(1)
        d = np.where(lists, own[:, None] - 2 * p @ c.T + size, np.inf)
        nearest = d.argmin(1)
        room = 1e-9 * (own + size.max()) + 1e-6
        margin = 2 * r[:, None] * between[nearest] * (1 + 1e-9) + room[:, None]
        lists &= d - d[np.arange(len(here)), nearest][:, None] <= margin
        lists[np.arange(len(here)), nearest] = True
        owned = lists.sum(1) == 1
        leaf = ~owned & (nodes["left"][here] < 0)
        np.add.at(sums, nearest[owned], nodes["sum"][here[owned]])
        np.add.at(counts, nearest[owned], (nodes["end"] - nodes["start"])[here[owned]])
        if labels is not None:
            for i in np.flatnonzero(owned):
                labels[nodes["start"][here[i]] : nodes["end"][here[i]]] = nearest[i]
        for i in np.flatnonzero(leaf):
            a, b = nodes["start"][here[i]], nodes["end"][here[i]]
            may = np.flatnonzero(lists[i])
            spots.append(np.arange(a, b))
            found.append(may[(weight[may] - 2 * (spot[a:b] @ entries[may].T)).argmin(1)])  # the first of equals is the lower index
        open_ = ~owned & ~leaf
        here, lists = np.concatenate([nodes["left"][here[open_]], nodes["right"][here[open_]]]), np.concatenate([lists[open_], lists[open_]])
    at, entry = np.concatenate(spots), np.concatenate(found)
    order = np.argsort(entry, kind="stable")
    at, entry = at[order], entry[order]
    if labels is not None:
        labels[at] = entry
    if len(at):
        begin = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]]))
        sums[entry[begin]] += np.add.reduceat(points[at], begin, axis=0)
        counts += np.bincount(entry, minlength=m)
    return sums, counts


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of a task in tables of ``size`` rows."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while rows + batch.num_rows >= size:
            cut = size - rows
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, rows, batch = [], 0, batch.slice(cut)
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    """A column as one list value."""
    values = column.combine_chunks()
    values = values if isinstance(values, pa.Array) else pa.concat_arrays(values.chunks)
    return pa.LargeListArray.from_arrays(pa.array([0, len(values)], pa.int64()), values).cast(pa.list_(values.type))


def _builder(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, CHUNK):
            flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table["vector"].chunks]).astype(np.float64)
            whole = np.floor(SCALE * flat).clip(-LARGEST, LARGEST).astype(np.int64).reshape(len(table), parts, -1)
            orders, points, balls = [], [], []
            for k in range(parts):
                order, nodes = build_tree(whole[:, k])
                orders.append(order.astype(np.int32).tobytes())
                points.append(whole[order, k].astype(np.int32).tobytes())
                balls.append(nodes.tobytes())
            columns = [_whole(table["vec_id"]), _whole(table["label"]), *(pa.array([v], pa.list_(pa.binary())) for v in (orders, points, balls))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_ids", "labels", "orders", "points", "balls"])

    return run


def _trees(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row, part, points, balls) of every tree in a batch."""
    points, balls = (batch.column(n) for n in ("points", "balls"))
    for row in range(batch.num_rows):
        for k, (p, b) in enumerate(zip(points[row].as_py(), balls[row].as_py(), strict=True)):
            yield row, k, np.frombuffer(p, np.int32).reshape(-1, width).astype(np.int64), np.frombuffer(b, _node(width))


def _round(books):
    """Sums and counts per part and entry of a task's trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = books.value
        sums, counts = np.zeros(book.shape, np.int64), np.zeros(book.shape[:2], np.int64)
        for batch in batches:
            for _, k, points, balls in _trees(batch, book.shape[2]):
                s, n = assign(points, balls, book[k])
                sums[k] += s
                counts[k] += n
        part, entry = np.nonzero(counts)
        columns = [part.astype(np.int32), entry.astype(np.int32), counts[part, entry], *sums[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["part", "entry", "n", *(f"s{j}" for j in range(book.shape[2]))])

    return run


def _coder(books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = books.value
        digits = np.array([f"{k:02x}" for k in range(book.shape[1])])
        for batch in batches:
            found: dict[int, tuple[list, np.ndarray]] = {}
            for row, k, points, balls in _trees(batch, book.shape[2]):
                labels = np.zeros(len(points), np.int64)
                assign(points, balls, book[k], labels)
                order = np.frombuffer(batch.column("orders")[row][k].as_py(), np.int32)
                codes, errors = found.setdefault(row, ([], np.zeros(len(points), np.int64)))
                errors[order] += ((points - book[k][labels]) ** 2).sum(1)
                code = np.empty(len(points), digits.dtype)
                code[order] = digits[labels]
                codes.append(code)
            for row, (codes, errors) in found.items():
                joined = codes[0]
                for more in codes[1:]:
                    joined = np.char.add(joined, more)
                ids, labels = batch.column("vec_ids")[row].values, batch.column("labels")[row].values
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(joined, pa.string()), pa.array(errors)], ["vec_id", "label", "code", "error"])

    return run


def usable(vector: Column, parts: int) -> Column:
    """Whether a vector has only finite components and a length that ``parts`` divides."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % parts == 0) & ~wrong


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable row of (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "label", F.col("embedding").alias("vector")).where(usable(F.col("embedding"), parts))
    order = [F.asc_nulls_last("vec_id"), "vector"]
    head = rows.orderBy(*order).limit(1).collect()
    dim = len(head[0]["vector"]) if head else parts
    rows = rows.where(F.size("vector") == dim)
    width = dim // parts
    first = np.array([r["vector"] for r in rows.orderBy(*order).limit(entries).select("vector").collect()], np.float64).reshape(-1, parts, width)
    books = np.ascontiguousarray(np.floor(SCALE * first).clip(-LARGEST, LARGEST).astype(np.int64).transpose(1, 0, 2))
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    stored = f"vec_ids array<{id_type}>, labels array<{label_type}>, orders array<binary>, points array<binary>, balls array<binary>"
    trees = materialize(rows.mapInArrow(_builder(parts), stored), "metric-trees")
    moments = ", ".join(["part int", "entry int", "n long", *(f"s{j} long" for j in range(width))])
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(books)
        found = trees.select("points", "balls").mapInArrow(_round(sent), moments).groupBy("part", "entry").agg(F.sum("n"), *(F.sum(f"s{j}") for j in range(width)))
        books = books.copy()
        for part, entry, n, *sums in found.collect():  # parts * entries rows at most
            books[part, entry] = [s // n for s in sums]
    sent = spark.sparkContext.broadcast(books)
    coded = materialize(trees.mapInArrow(_coder(sent), f"vec_id {id_type}, label {label_type}, code string, error long"), "vector-codes")
    labels = materialize(coded.groupBy(F.col("label").alias("__label")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    known = labels.count()
    if known <= LABELS:
        both = coded.join(broadcast_if_small(labels, known, LABELS), F.col("label").eqNullSafe(F.col("__label")))
    else:  # a label may be a third of all rows, so each is dealt into shares
        dealt = labels.withColumn("__share", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = coded.withColumn("__own", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")).join(dealt, F.col("label").eqNullSafe(F.col("__label")) & (F.col("__own") == F.col("__share")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
