"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in
alternation, ending with the assistant. Dynamic programming over that automaton
picks the cheapest repair: merge a turn into the one before, relabel it, or insert
empty turns; equal costs prefer the turn's own role, then system, user, assistant.

Costs compose, so a conversation need not sit in one task. Rows are dealt by range
of (conversation, turn, role, text) and numbered; ``BLOCK`` consecutive rows form a
block, whatever their turn numbers are. Each block becomes a small table of cheapest
costs from every entry role to every exit role, ``BLOCK`` tables compose into one of
the level above until a conversation has a single table, and entry and exit roles
go back down the same levels to the rows. Only roles and row numbers take part; no
group has more than ``BLOCK`` entries, and texts are joined to the repaired rows at
the end. Output is one row per turn, whose ``segment`` texts, in order of turn, make
the rendered conversation.

Defined cases: a null or unknown role must be relabelled; a null text is empty;
turns that tie in number are ordered by role and text; rows without a turn number
come first; rows without conv_id form one conversation; repeated rows are turns
of their own; markup inside a text is broken up; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eraloom.plans.scratch import materialize

ROLES = ["system", "user", "assistant"]
START = 3
NEXT = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
MERGE, RELABEL, INSERT = 1, 3, 2
FAR = 1 << 40
BLOCK = 64
#: Characters of a text that take part in the dealing of rows; tasks sort by whole texts.
PREFIX = 200
RESULT = "conv_id long, turn long, role string, role_out string, action string, inserted long, segment string"


def _between(last: int, role: int) -> list[int] | None:
    """Shortest run of roles to insert so that ``role`` may follow ``last``."""
    paths = [[last]]
    for path in paths:
        if role in NEXT[path[-1]]:
            return path[1:]
        if len(path) < 5:
            paths += [[*path, r] for r in NEXT[path[-1]]]
    return None


INSERTED = {(s, q): _between(s, q) for s, q in product(range(4), range(3))}
ENDING = {s: [] if s == 2 else _between(s, 2) + [2] for s in range(4)}


def _cost(last: int, role: str | None, new: int) -> int:
    relabel = 0 if role == ROLES[new] else RELABEL
    if last == new:
        return relabel + MERGE
    path = INSERTED[last, new]
    return FAR if path is None else relabel + INSERT * len(path)


def table(roles: list[str | None]) -> list[int]:
    """Cheapest costs of a block, entry role by exit role (4 by 3, flat)."""
    out = []
    for entry in range(4):
        costs = {entry: 0}
        for role in roles:
            costs = {q: min(c + _cost(s, role, q) for s, c in costs.items()) for q in range(3)}
        out += [min(costs[q], FAR) for q in range(3)]
    return out


def compose(tables: list[list[int]]) -> list[int]:
    """One table for consecutive tables."""
    out = []
    for entry in range(4):
        costs = {entry: 0}
        for t in tables:
            costs = {q: min(c + t[3 * s + q] for s, c in costs.items()) for q in range(3)}
        out += [min(costs[q], FAR) for q in range(3)]
    return out


def best_leave(whole: list[int]) -> int:
    """Exit role of a cheapest path through a whole conversation's table and its ending."""
    return min((whole[3 * START + q] + INSERT * len(ENDING[q]), q) for q in range(3))[1]


def join_tables(tables: list[list[int]], entry: int = START, leave: int | None = None) -> list[tuple[int, int]]:
    """Entry and exit role of each table on a cheapest path from ``entry`` to ``leave``,
    or to the end of the conversation."""
    costs, back = {entry: 0}, []
    for t in tables:
        best = {q: min((c + t[3 * s + q], s) for s, c in costs.items()) for q in range(3)}
        back.append({q: s for q, (_, s) in best.items()})
        costs = {q: c for q, (c, _) in best.items()}
    state = min((c + INSERT * len(ENDING[q]), q) for q, c in costs.items())[1] if leave is None else leave
    path = []
    for step in reversed(back):
        path.append((step[state], state))
        state = step[state]
    return path[::-1]


def repair(roles: list[str | None], entry: int, leave: int) -> list[int]:
    """New role of each turn on a cheapest path from entry to leave."""
    costs, back = {entry: 0}, []
    for role in roles:
        best = {q: min((c + _cost(s, role, q), role != ROLES[q], s) for s, c in costs.items()) for q in range(3)}
        back.append({q: x[2] for q, x in best.items()})
        costs = {q: x[0] for q, x in best.items()}
    out, state = [], leave
    for step in reversed(back):
        out.append(state)
        state = step[state]
    return out[::-1]


def _open(role: int) -> str:
    return f"<|{ROLES[role]}|>\n"


CLOSE = "<|end|>\n"


def _batch(schema: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, _TYPES[t]) for c, t in zip(columns, (x.split()[1] for x in schema.split(", ")), strict=True)], names=[x.split()[0] for x in schema.split(", ")])


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
TABLES = "conv_id long, block long, costs array<long>"
PATHS = "conv long, at long, entry int, leave int, last boolean"
REPAIRED = "seq long, before int, now int, ends boolean"


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _batch(TABLES, b.column("conv_id"), b.column("block"), [table([t["role"] for t in turns]) for turns in b.column("turns").to_pylist()])


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _batch(TABLES, b.column("conv_id"), b.column("block"), [compose([p["costs"] for p in parts]) for parts in b.column("parts").to_pylist()])


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = b.num_rows
        yield _batch(PATHS, b.column("conv_id"), b.column("block"), [START] * n, list(map(best_leave, b.column("costs").to_pylist())), [True] * n)


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for r in b.to_pylist():
            path = join_tables([p["costs"] for p in r["parts"]], r["entry"], r["leave"])
            rows += [(r["conv_id"], p["block"], s, q, r["last"] and k == len(path) - 1) for k, (p, (s, q)) in enumerate(zip(r["parts"], path, strict=True))]
        yield _batch(PATHS, *(zip(*rows, strict=True) if rows else [[]] * 5))


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for r in b.to_pylist():
            before = r["entry"]
            for k, (t, now) in enumerate(zip(r["turns"], repair([t["role"] for t in r["turns"]], before, r["leave"]), strict=True)):
                rows.append((t["seq"], before, now, r["last"] and k == len(r["turns"]) - 1))
                before = now
        yield _batch(REPAIRED, *(zip(*rows, strict=True) if rows else [[]] * 4))


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for role, text, before, now, ends in zip(*(b.column(c).to_pylist() for c in ("role", "text", "before", "now", "ends")), strict=True):
            merged = before == now
            extra = [] if merged else INSERTED[before, now]
            segment = "\n" if merged else ("" if before == START else CLOSE) + "".join(_open(r) + CLOSE for r in extra) + _open(now)
            segment += (text or "").replace("<|", "< |")
            inserted = len(extra)
            if ends:
                segment += CLOSE + "".join(_open(r) + CLOSE for r in ENDING[now])
                inserted += len(ENDING[now])
            done = [x for x, on in (("relabel", role != ROLES[now]), ("merge", merged)) if on]
            rows.append((ROLES[now], "+".join(done) or "keep", inserted, segment))
        yield _batch(RESULT, b.column("conv_id"), b.column("turn"), b.column("role"), *(zip(*rows, strict=True) if rows else [[]] * 4))


def _numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, seq, role, no): each row's number in its conversation, from 0. ``turns`` is in
    order of ``seq`` within ``part``, and parts are ranges of conversations and turns."""
    counts = turns.groupBy("part", "conv_id").agg(F.count(F.lit(1)).alias("rows"), F.min("seq").alias("first"))
    earlier = F.sum("rows").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col("part").alias("p"), F.col("conv_id").alias("c"), (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"))
    both = turns.join(starts, (F.col("part") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("c")))
    return both.select("conv_id", "seq", "role", (F.col("seq") + F.col("shift")).alias("no"))


def _groups(tables: DataFrame) -> DataFrame:
    """(conv_id, block, parts): up to BLOCK tables of one level under their block of the next."""
    return tables.groupBy("conv_id", F.floor(F.col("block") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("block", "costs"))).alias("parts"))


def _on_path(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    return blocks.join(paths, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("block") == F.col("at"))).drop("conv", "at", "block")


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per turn: its repaired role, what was done, and its rendered segment."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    # Equal rows may part anywhere, so that thousands of them are dealt to several tasks.
    longer = F.coalesce(F.char_length("text") > PREFIX, F.lit(False))
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, PREFIX), longer, F.when(longer, F.lit(0.0)).otherwise(F.rand(1)))
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id())
    turns = materialize(ordered, "chat-turns")
    blocks = _numbered(turns).groupBy("conv_id", F.floor(F.col("no") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("no", "seq", "role"))).alias("turns"))
    blocks = materialize(blocks, "chat-blocks")
    levels = [materialize(blocks.mapInArrow(_tables, TABLES), "chat-tables")]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) > 0:
        levels.append(materialize(_groups(levels[-1]).mapInArrow(_compose, TABLES), "chat-tables"))
    paths = levels.pop().mapInArrow(_tops, PATHS)
    for tables in reversed(levels):
        paths = _on_path(_groups(tables), paths).mapInArrow(_down, PATHS)
    repaired = _on_path(blocks, paths).mapInArrow(_repair, REPAIRED)
    return turns.join(repaired, "seq").select("conv_id", "turn", "role", "text", "before", "now", "ends").mapInArrow(_render, RESULT)
