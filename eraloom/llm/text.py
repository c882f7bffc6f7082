"""Word splitting and hashing used inside tasks, and the way of rows into them."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: A word memo is emptied at this many entries, so that memory stays bounded.
MEMO = 100_000
#: Rows that are Python objects at once: a worker keeps the memory of its largest frame for later stages.
FRAME = 1_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


class WordHash(dict):
    """Memo from a word's bytes to its 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def map_rows(rows: DataFrame, kept: list[str], run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``run`` over the other columns in pandas, one row out for each row in and one frame for each frame;
    the ``kept`` columns go beside it in Arrow, so that a 64-bit id among nulls never is floating point."""
    types = {f.name: to_arrow_type(f.dataType) for f in StructType.fromDDL(schema).fields}

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: deque[pa.RecordBatch] = deque()

        def frames() -> Iterator[pd.DataFrame]:
            for batch in batches:
                for k in range(0, batch.num_rows, FRAME):
                    part = batch.slice(k, FRAME)
                    waiting.append(part.select(kept))
                    yield part.drop_columns(kept).to_pandas()

        for out in run(frames()):
            beside = waiting.popleft()
            columns = [beside.column(c) if c in kept else pa.array(out[c], t, from_pandas=True) for c, t in types.items()]
            yield pa.RecordBatch.from_arrays(columns, list(types))

    return rows.mapInArrow(go, schema)


def words(text: str | None) -> list[bytes]:
    """ASCII-lower-cased words: runs without space, tab, LF, VT, FF, CR."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(tokens: list[bytes], memo: WordHash) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(32))) * _STEP
    x = (x ^ (x >> np.uint64(32))) * _STEP
    return x ^ (x >> np.uint64(32))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (none if there are fewer)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for k in range(size):
            out = out * _MIX + hashes[k : k + n]
            out ^= out >> np.uint64(29)
        return mix(out)


def shingles(text: str | None, size: int, memo: WordHash) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, an empty one none."""
    tokens = words(text)
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = word_hashes(tokens, memo)
    if len(tokens) < size:  # the whole sequence, apart from every full shingle by its length
        with np.errstate(over="ignore"):
            return windows(hashes, len(tokens)) + np.uint64(len(tokens))
    return np.unique(windows(hashes, size))
