"""Cross-tokenizer alignment by diagonal run skipping.

Every text is encoded by two tokenizers over the same bytes, a space and the text: a
byte-level one (A) and a piece-level one (B). Where tokens of both end at the same byte
the text is cut into groups; within a group every pair of overlapping tokens is a link.

``align`` walks the two arrays of token ends along the current diagonal (index of B
minus index of A): slices of doubling length are compared there, and halved once they differ,
so a one-to-one stretch costs few comparisons however long it is. Where the ends part,
a local walk steps the side that ends first until both meet; that is one irregular
group, and the diagonal moves by the difference of its sizes. Both write their links
down as moves, one byte each.

Encoding is shared by words: a word between single spaces is encoded alike wherever it
occurs, as no token of either tokenizer reaches over such a space (B's pieces hold
their mark only at their start, which is checked; A cuts before it). Words are encoded by
the libraries, a bounded memo (``MEMO_BYTES``) keeps them, and texts with other
runs of white space are encoded whole.

How often an id pair is linked in the whole corpus takes three steps. The links of about
``CHUNK_LINKS`` consecutive links become one row with each pair once; pairs are
summed over rows, with a B id's highest count beside them; the counts
go back to the rows they came from as one array each, and the rows add them up
by document. So a pair is shuffled once for each chunk, not for each occurrence: a pair that
makes a third of all links is one row in each chunk. A chunk ends after a whole
document, so its size is bounded by CHUNK_LINKS and the longest document.

Defined cases: null and empty texts, and texts whose joined tokens of A or B differ
from the space and the text in UTF-8 (B reads its own mark U+2581 as a space), have no
tokens: zeros and an empty digest. Null and repeated doc_ids are kept as rows of their own.
Tokenizers' special tokens inside texts are plain text. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eraloom.plans.scratch import materialize

MARK = "▁"
#: Links of a chunk, bytes of text that are encoded together, and bytes that a worker's memo may hold.
CHUNK_LINKS, BATCH_BYTES, MEMO_BYTES = 1 << 20, 1 << 21, 160 << 20
#: Words of one call of a library.
JOINED = 4096
#: White space in any reading of the term; a space beside one of these is no cut.
_SPACE = r"[\s\x1c-\x1f\x85\u180e\u200b-\u200d\u2060\ufeff]"
_WITHIN = re.compile(f"^{_SPACE}|{_SPACE}{_SPACE}|{_SPACE}$")


def _cut_by_spaces(text: str) -> bool:
    """Whether every space stands between characters that are no white space."""
    if text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text:
        return False
    return text.replace("\n", "").isprintable() or not _WITHIN.search(text)


#: Moves from one link to the next: A's token, B's token, or both; a group ends where both move.
_A, _B, _BOTH = b"\x01", b"\x02", b"\x03"
#: Ends that are compared first in a stretch.
FIRST_STEP = 8


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The links of two arrays of ends over the same bytes, in order, each as the move that follows it."""
    n, raw_a, raw_b = len(ends_a), ends_a.astype(np.int32).tobytes(), ends_b.astype(np.int32).tobytes()
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    moves = bytearray()
    i = j = 0
    while i < n:
        a, b = list_a[i], list_b[j]
        if a == b:  # a stretch on the diagonal j - i: probe ahead by doubling, then halve the slice that differs
            k, step = i + 1, FIRST_STEP
            shift = j - i
            while k < n and raw_a[4 * k : 4 * (k + step)] == raw_b[4 * (k + shift) : 4 * (k + shift + step)]:
                k, step = k + step, 2 * step
            k = min(k, n)
            while step > 1 and k < n:
                step //= 2
                if raw_a[4 * k : 4 * (k + step)] == raw_b[4 * (k + shift) : 4 * (k + shift + step)]:
                    k = min(k + step, n)
            moves += _BOTH * (k - i)
            i, j = k, k + shift
            continue
        while a != b:
            if a < b:
                moves += _A
                i += 1
                a = list_a[i]
            else:
                moves += _B
                j += 1
                b = list_b[j]
        moves += _BOTH
        i, j = i + 1, j + 1
    return np.frombuffer(moves, np.uint8)


def links(moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of A's and of B's token of every link."""
    return tuple(np.concatenate([[0], part.cumsum(dtype=np.int64)[:-1]]) if len(moves) else np.empty(0, np.int64) for part in (moves & 1, moves >> 1))


def byte_alphabet() -> dict[str, int]:
    """The byte of each character that byte-level vocabularies write: printable ones stand for themselves, the rest follow 255."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Pair:
    """The two tokenizers with the bytes and digits of their entries."""

    def __init__(self, byte_level: str, piece_level: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = sp = sentencepiece.SentencePieceProcessor(model_proto=piece_level)
        alphabet = byte_alphabet()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.n_a, self.n_b = max(names) + 1, sp.get_piece_size()
        self.bytes_a = [bytes(alphabet.get(c, 0) for c in names.get(i, "")) for i in range(self.n_a)]
        pieces = [sp.id_to_piece(i) for i in range(self.n_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        #: Digits of every entry as they stand inside and at the end of A's and B's part of a group.
        self.names = np.array([f"{i}{mark}" for n, marks in ((self.n_a, ",|"), (self.n_b, ",;")) for mark in marks for i in range(n)], object)
        self.by_words = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.memo_a: dict[str, bytes] = {}
        self.memo_b: dict[str, bytes] = {}
        self.odd: set[str] = set()  # words whose bytes are not those of their tokens
        self.held = 0

    def both(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of whole texts by the libraries, as int32 bytes; None where the joined bytes are not the text's."""
        found_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        found_b = self.b.encode(texts, num_threads=1)
        out: list[tuple[bytes, bytes] | None] = []
        for text, a, b in zip(texts, found_a, found_b, strict=True):
            out.append((np.array(a, np.int32).tobytes(), np.array(b, np.int32).tobytes()) if self.same(text, a, b) else None)
        return out

    def same(self, text: str, a: list[int], b: list[int]) -> bool:
        return b"".join(map(self.bytes_a.__getitem__, a)) == (" " + text).encode() == b"".join(map(self.bytes_b.__getitem__, b))

    def words(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        """``both`` for words without white space beside them, many in one call of each library."""
        out: list[tuple[bytes, bytes] | None] = []
        for k in range(0, len(words), JOINED):
            some = words[k : k + JOINED]
            text = " ".join(some)
            a, b = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text, num_threads=1)
            stops = np.array([len(w.encode()) + 1 for w in some]).cumsum()
            if not self.same(text, a, b):
                out += self.both(some)
                continue
            cut = []
            for ids, length in ((np.array(a, np.int32), self.length_a), (np.array(b, np.int32), self.length_b)):
                raw, at = ids.tobytes(), (4 * (np.searchsorted(length[ids].cumsum(), stops) + 1)).tolist()
                cut.append([raw[x:y] for x, y in zip([0, *at], at, strict=False)])
            out += zip(*cut, strict=True)
        return out

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of A and B for non-empty texts, None where their bytes are not the text's; each distinct word is encoded once."""
        cut = [t.split(" ") if self.by_words and _cut_by_spaces(t) else None for t in texts]
        whole = iter(self.both([t for t, words in zip(texts, cut, strict=True) if words is None]))
        missing = [w for w in set().union(*(c for c in cut if c)) if w not in self.memo_a and w not in self.odd]
        for word, ids in zip(missing, self.words(missing), strict=True):
            self.held += 330 + 8 * len(word)
            if ids:
                self.memo_a[word], self.memo_b[word] = ids
                self.held += len(ids[0]) + len(ids[1])
            else:
                self.odd.add(word)
        out = []
        for words in cut:
            if words is None:
                found = next(whole)
            elif self.odd and not self.odd.isdisjoint(words):
                found = None
            else:
                found = b"".join(map(self.memo_a.__getitem__, words)), b"".join(map(self.memo_b.__getitem__, words))
            out.append(found and tuple(np.frombuffer(x, np.int32) for x in found))
        if self.held > MEMO_BYTES:
            self.memo_a.clear()
            self.memo_b.clear()
            self.odd.clear()
            self.held = 0
        return out

    def align(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return align(self.length_a[a].cumsum(), self.length_b[b].cumsum())

    def groups(self, a: np.ndarray, b: np.ndarray, moves: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> str:
        """All groups as ``a1,a2|b1;a3|b2,b3``: A's tokens of a group, then B's, each name with the mark behind it."""
        closing = moves == 3
        ends_a, ends_b = at_a[closing] + 1, at_b[closing] + 1  # one past each group's last token
        name_a, name_b = a.astype(np.int64), b.astype(np.int64) + 2 * self.n_a
        name_a[ends_a - 1] += self.n_a
        name_b[ends_b - 1] += self.n_b
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(np.concatenate([[0], ends_b[:-1]]), np.diff(ends_a, prepend=0))] = name_a
        order[np.arange(len(b)) + np.repeat(ends_a, np.diff(ends_b, prepend=0))] = name_b
        return "".join(self.names[order].tolist())[:-1]


@functools.lru_cache(maxsize=1)
def _pair(byte_level: str, piece_level: bytes) -> Pair:
    """One pair for a worker process, so that its memo serves all its tasks."""
    return Pair(byte_level, piece_level)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """doc_ids and texts of a task, about BATCH_BYTES of text at a time."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        begin = size = 0
        for k, text in enumerate(texts):
            size += len(text or "")
            if size >= BATCH_BYTES or k + 1 == len(texts):
                yield ids[begin : k + 1], texts[begin : k + 1]
                begin, size = k + 1, 0


class Chunk:
    """Documents and their links, gathered until there are enough."""

    def __init__(self):
        self.ids: list[pa.Array] = []
        self.rows: list[tuple[int, int, int, int, str]] = []
        self.links: list[np.ndarray] = []
        self.size = 0

    def add(self, row: tuple[int, int, int, int, str], links: np.ndarray) -> None:
        self.rows.append(row)
        self.links.append(links)
        self.size += len(links)

    def batch(self, number: int) -> pa.RecordBatch:
        links = np.concatenate([np.empty(0, np.int64), *self.links])
        codes, place, counts = np.unique(links, return_inverse=True, return_counts=True)
        places = place.astype(np.uint16 if len(codes) <= 1 << 16 else np.uint32).tobytes()
        n_a, n_b, n_groups, n_links, digests = zip(*self.rows, strict=True)
        lists = [pa.array([v], pa.list_(pa.int64())) for v in (n_a, n_b, n_groups, n_links)]
        ids = pa.concat_arrays(self.ids)
        ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        columns = [pa.array([number], pa.int64()), ids, *lists, pa.array([digests], pa.list_(pa.string())), pa.array([places], pa.binary()), pa.array([codes.tolist()], pa.list_(pa.int64())), pa.array([counts.tolist()], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "digests", "places", "codes", "counts"])


def _aligner(files):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*files.value)
        number = TaskContext.get().partitionId() << 32
        chunk, none = Chunk(), np.empty(0, np.int64)
        for ids, texts in _portions(batches):
            filled = [t for t in texts if t]
            found = dict(zip((k for k, t in enumerate(texts) if t), pair.encode(filled) if filled else [], strict=True))
            begin = 0
            for k in range(len(texts)):
                if ids_of := found.get(k):
                    a, b = ids_of
                    moves = pair.align(a, b)
                    at_a, at_b = links(moves)
                    text = pair.groups(a, b, moves, at_a, at_b)
                    chunk.add((len(a), len(b), int((moves == 3).sum()), len(moves), hashlib.sha256(text.encode()).hexdigest()), a[at_a].astype(np.int64) * pair.n_b + b[at_b])
                else:
                    chunk.add((0, 0, 0, 0, ""), none)
                if chunk.size >= CHUNK_LINKS:
                    chunk.ids.append(ids[begin : k + 1])
                    yield chunk.batch(number)
                    chunk, number, begin = Chunk(), number + 1, k + 1
            if begin < len(texts):
                chunk.ids.append(ids[begin:])
        if chunk.rows:
            yield chunk.batch(number)

    return run


def _summer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per document from a chunk's places and the corpus-wide counts of its pairs."""
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda name: batch.column(name)[row]  # noqa: E731, B023
            totals, best = (np.array([] if get(c).as_py() is None else get(c).values.to_numpy(zero_copy_only=False)) for c in ("totals", "best"))
            places = np.frombuffer(get("places").as_py(), np.uint16 if len(totals) <= 1 << 16 else np.uint32)
            stops = get("n_links").values.to_numpy().cumsum()
            sums = [np.concatenate([[0], values[places].astype(np.int64).cumsum()])[stops] if len(totals) else np.zeros(len(stops), np.int64) for values in (totals, best)]
            count_sum, n_best = (np.diff(s, prepend=0) for s in sums)
            columns = [get("doc_ids").values, *(get(c).values for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(n_best), pa.array(count_sum), get("digests").values]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def _files(docs: DataFrame, byte_level: str, piece_level: str):
    """Both tokenizer files on all executors."""
    with open(byte_level, encoding="utf-8") as a, open(piece_level, "rb") as b:
        return docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))


def alignments(docs: DataFrame, byte_level: str, piece_level: str) -> DataFrame:
    """doc_id and its groups, arrays of A's and B's ids each; null without tokens."""
    files = _files(docs, byte_level, piece_level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*files.value)
        for ids, texts in _portions(batches):
            out = []
            for text in texts:
                ids_of = pair.encode([text])[0] if text else None
                if ids_of is None:
                    out.append(None)
                    continue
                a, b = ids_of
                moves = pair.align(a, b)
                cuts = [(at[moves == 3] + 1)[:-1] for at in links(moves)]
                out.append([{"a": x.tolist(), "b": y.tolist()} for x, y in zip(np.split(a, cuts[0]), np.split(b, cuts[1]), strict=True)])
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])))], ["doc_id", "groups"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, groups array<struct<a:array<int>,b:array<int>>>")


def link_counts(pairs: DataFrame, n_b: int) -> DataFrame:
    """(code, total, best) from (code, n): a pair's links in the corpus, and whether no pair of its B id has more.
    A B id has as many pairs as A has ids at most, so its window is bounded."""
    totals = pairs.groupBy("code").agg(F.sum("n").alias("total"))
    most = F.max("total").over(Window.partitionBy(F.col("code") % n_b))
    return totals.select("code", "total", (F.col("total") == most).alias("best"))


def align_corpus(docs: DataFrame, byte_level: str, piece_level: str) -> DataFrame:
    """Per row: doc_id, tokens of each side, groups, links, links that are the best of
    their B id, sum of the links' counts, and the digest of the groups."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    n_b = sentencepiece.SentencePieceProcessor(model_file=piece_level).get_piece_size()
    stored = f"chunk long, doc_ids array<{id_type}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, digests array<string>, places binary, codes array<long>, counts array<long>"
    chunks = materialize(docs.select("doc_id", "text").mapInArrow(_aligner(_files(docs, byte_level, piece_level)), stored), "aligned-chunks")
    pairs = chunks.select("chunk", F.posexplode(F.arrays_zip("codes", "counts")).alias("place", "pair")).select("chunk", "place", F.col("pair.codes").alias("code"), F.col("pair.counts").alias("n"))
    counts = materialize(link_counts(pairs.select("code", "n"), n_b), "link-counts")
    known = pairs.select("chunk", "place", "code").join(counts, "code")
    back = known.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("place", "total", "best"))).alias("known"))
    back = back.select("chunk", F.col("known.total").alias("totals"), F.col("known.best").alias("best"))
    rows = chunks.drop("codes", "counts").join(back, "chunk", "left")
    result = f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.mapInArrow(_summer, result)
