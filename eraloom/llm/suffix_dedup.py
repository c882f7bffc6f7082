"""Removal of long repeated byte strings with two-stage suffix sorting.

Every byte covered by a ``LENGTH``-byte string that also starts in a document
with a smaller doc_id is removed. Strings are judged on the input.

A corpus cannot be sorted in one place, so the suffixes that can share a string
are brought together first. The minimizer of a string (the leftmost smallest hash
among its WINDOW grams of ``GRAM`` bytes, where WINDOW + GRAM - 1 = LENGTH) is its
anchor: equal strings have equal anchors, always. Consecutive strings of one anchor
are a context, named by a hash of the bytes they cover.

1. Each context goes to its anchor as a few numbers: document, place, name. An
   anchor held by a single document is dropped (it cannot share a string). Of
   contexts of one name all but those of the smallest doc_id fall whole; where an
   anchor has several names, one context of each is wanted for sorting.
2. The answers go to their documents: whole contexts become spans, wanted ones
   are read from the text.
3. Wanted contexts meet in the suffix sorter: they are concatenated in bounded
   blocks, suffixes smaller than their successors are sorted directly, all others
   are induced by bucket scans, and adjacent common prefixes of LENGTH bytes or
   more group equal strings; each group's smallest doc_id tells which strings
   fall. The contexts of an anchor with more than ``most`` names (the edge of a
   passage that very many documents share) are cut into their strings, dealt by
   hash to as many sorter keys as that takes.
4. Spans meet their documents, are merged and cut from the bytes.

Between tasks these numbers travel as columns packed in one binary for each bucket
of anchors or documents, so that an exchange moves few rows and a task works on
whole arrays.

Hot groups: contexts and strings that a batch already holds in several
documents are settled in the batch, and one of each goes on; so a string held
by a third of all documents costs its key a few numbers per batch. An anchor that
very many documents of a batch hold under different names gets one row that says so;
its contexts are cut into their strings everywhere, without its verdict. No
text is collected; longer texts are taken in pieces of ``PIECE`` bytes, whose
overlap gives every string to one piece; touching repeats inside one document (a long
run of one byte) become one.

Defined cases: a null text is empty; texts under LENGTH bytes lose nothing; rows
that repeat a doc_id are one document for the rule (a row's strings do not fall
because of another row of the same id) and each row gets its own result; rows
without a doc_id lose nothing and cause no removal; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eraloom.llm.text import mix
from eraloom.plans.scratch import materialize

LENGTH = 50
GRAM = 20
WINDOW = LENGTH - GRAM + 1
#: Different contexts of one anchor that meet under one key of the suffix sorter.
MOST = 4_000
BLOCK = 1 << 20
PIECE = 1 << 20
#: Bytes of whole texts that are hashed at once, and contexts or bytes that a task holds before they go on.
CHUNK = 1 << 17
#: An anchor is crowded where more documents of a batch hold it than this, and than a sixteenth of them.
CROWD = 32
HELD = 1 << 19
_BASE = 0x9E3779B97F4A7C55
_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, np.uint64)
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 2**64)
    out = []
    for base in (_BASE, inverse):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every ``width`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def _runs(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The contexts of the texts that lie one behind the other in ``raw``: text, first start, number
    of bytes, hash of the anchor, name."""
    n = len(raw) - LENGTH + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    up, down = _powers(1 << max(18, len(raw).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    scaled = np.take(_BYTES, raw)
    scaled *= down[: len(raw)]
    np.cumsum(scaled, out=sums[1:])
    grams = sums[GRAM:] - sums[:-GRAM]
    grams *= up[: len(grams)]
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(_BASE)
    least = _sliding(grams, WINDOW, np.minimum)
    # The anchor moves on where a smaller hash comes in, and behind a string that begins with it.
    new = np.ones(n, bool)
    new[1:] = (least[1:] < least[:-1]) | (grams[: n - 1] == least[:-1])
    new[begin[begin < n]] = True
    start = np.flatnonzero(new)
    text = np.searchsorted(begin, start, "right") - 1
    stop = np.minimum(np.append(start[1:], n), end[text] - LENGTH + 1)
    some = stop > start
    start, text = start[some], text[some]
    size = stop[some] - start + LENGTH - 1
    name = mix((sums[start + size] - sums[start]) * up[start] + size.astype(np.uint64))
    return text, start, size, mix(least[start]), name


def _words(text: np.ndarray) -> np.ndarray:
    """Eight bytes from every position on, as one big-endian number; zeros past the end (to 56 bytes beyond)."""
    padded = np.concatenate([text, np.zeros(72, np.uint8)])
    out = np.zeros(len(text) + 64, np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(out)]
    return out


def _dense(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``x`` and each value's place among the different values."""
    order = np.argsort(x)
    place = np.empty(len(x), np.uint64)
    place[order] = np.cumsum(np.diff(x[order], prepend=x[order[:1]]) != 0, dtype=np.uint64)
    return order, place


def _sorted_directly(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``at`` in order of the 56 bytes from there on. Words become their places among the words of
    the block, as many of which as fit share one number, until one is left to sort."""
    _, place = _dense(words)
    columns = [place[at + s] for s in range(0, 56, 8)]
    bits = len(words).bit_length()
    fit = 63 // bits
    while True:
        packed = []
        for k in range(0, len(columns), fit):
            out = columns[k]
            for c in columns[k + 1 : k + fit]:
                out = (out << np.uint64(bits)) | c
            packed.append(out)
        if len(packed) == 1:
            return at[np.argsort(packed[0])]
        columns = [_dense(c)[1] for c in packed]


def suffix_array(text: np.ndarray, words: np.ndarray | None = None, wanted: np.ndarray | None = None) -> np.ndarray:
    """Suffixes in order of their first LENGTH bytes at least, by two-stage sorting.

    Suffixes smaller than their successors are sorted directly (to 56 bytes);
    the others follow by scanning buckets of first bytes from small to large: a
    suffix in its place puts its predecessor, if that is larger, next in the
    bucket of the predecessor's first byte. With ``wanted`` only the suffixes it
    marks, and those behind them on which their place depends, are sorted.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    change = np.flatnonzero(text[:-1] != text[1:])
    before = np.zeros(n, np.int64)
    before[change + 1] = 1
    where = np.cumsum(before)
    next_change = np.append(change, n - 1)[np.minimum(where, len(change))]
    smaller = np.zeros(n, bool)
    inner = next_change < n - 1
    smaller[inner] = text[next_change[inner]] < text[next_change[inner] + 1]
    direct = np.flatnonzero(smaller)
    needed = None
    if wanted is not None:
        at = np.flatnonzero(wanted)
        steps = np.zeros(n + 1, np.int32)
        steps[:-1] = wanted
        ends = np.append(direct, n - 1)[np.searchsorted(direct, at)]
        steps -= np.bincount(ends + 1, minlength=n + 1).astype(np.int32)
        needed = np.cumsum(steps[:-1]) > 0
        direct = direct[needed[direct]]
    direct = _sorted_directly(_words(text) if words is None else words, direct)
    direct_first = text[direct]
    bounds = np.searchsorted(direct_first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if needed is None or needed[n - 1]:
        waiting[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        fresh = np.concatenate(waiting[c]) if waiting[c] else np.empty(0, np.int64)
        if not len(fresh) and bounds[c] == bounds[c + 1]:
            continue
        bucket = [fresh]
        while len(fresh):
            before = fresh[fresh > 0] - 1
            fresh = before[text[before] == c]
            if needed is not None:
                fresh = fresh[needed[fresh]]
            bucket.append(fresh)
        bucket.append(direct[bounds[c] : bounds[c + 1]])
        order = np.concatenate(bucket)
        out.append(order)
        before = order[order > 0] - 1
        if needed is not None:
            before = before[needed[before]]
        before = before[text[before] > c]
        if len(before):
            first = text[before]
            by = np.argsort(first, kind="stable")
            cuts = np.flatnonzero(np.diff(first[by])) + 1
            for part in np.split(before[by], cuts):
                waiting[text[part[0]]].append(part)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """Length of the common prefix of each suffix and the next in order, at most 56."""
    words = _words(text) if words is None else words
    out = np.full(max(len(order) - 1, 0), 56, np.int64)
    alive = np.arange(len(out))
    for step in range(0, 56, 8):
        d = words[order[alive] + step] ^ words[order[alive + 1] + step]
        ends = d != 0
        last = d[ends]
        out[alive[ends]] = step + sum(((last < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(1, 8)), np.zeros(len(last), np.int64))
        alive = alive[~ends]
    return out


def _hits(text: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Part and start of the LENGTH-byte strings that a part of a smaller doc holds too, in order."""
    end = np.cumsum(sizes)
    begin = end - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(text)) + LENGTH <= end[owner]
    if not inside.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    words = _words(text)
    order = suffix_array(text, words, inside)
    order = order[inside[order]]
    group = np.concatenate([[0], np.cumsum(common_prefixes(text, order, words) < LENGTH)])
    heads = np.flatnonzero(np.diff(group, prepend=-1))
    whose = docs[owner[order]]
    hit = np.sort(order[np.minimum.reduceat(whose, heads)[group] < whose])
    return owner[hit], hit - begin[owner[hit]]


def _merge(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans in order of row and ``lo``, those of a row that touch as one."""
    if not len(row):
        return row, lo, hi
    base = row.astype(np.int64) << 32
    top = np.maximum.accumulate(base + hi)
    new = np.ones(len(row), bool)
    new[1:] = (base + lo)[1:] > top[:-1]
    at = np.flatnonzero(new)
    return row[at], lo[at], top[np.append(at[1:], len(row)) - 1] - base[at]


def covered(parts: list[bytes], docs: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each part, the spans covered by a LENGTH-byte string that a part of a smaller doc holds too."""
    part, start = _hits(np.frombuffer(b"".join(parts), np.uint8), np.fromiter(map(len, parts), np.int64, len(parts)), docs)
    found: list[list[tuple[int, int]]] = [[] for _ in parts]
    for p, lo, hi in zip(*(x.tolist() for x in _merge(part, start, start + LENGTH)), strict=True):
        found[p].append((lo, hi))
    return found


def _pieces(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of pieces that give every LENGTH-byte string to one piece."""
    for lo in range(0, max(len(data) - LENGTH + 1, 1), PIECE):
        yield lo, data[lo : lo + PIECE + LENGTH - 1] if len(data) > PIECE else data


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a binary column without nulls, and the bounds of each."""
    column = column.cast(pa.large_binary())
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8), bounds


def _ragged(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``begin[k]``, ``begin[k] + 1`` ... of every k, ``sizes[k]`` of them."""
    return np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


#: Columns of the packed tables; the first is written as differences.
PLACE = {"doc": "i8", "tag": "i8", "key": "u4", "name": "u8", "pos": "i4", "size": "u1", "reach": "i4"}
ANSWER = {"doc": "i8", "tag": "i8", "pos": "i4", "size": "u1", "reach": "i4", "name": "u8", "group": "u8", "n": "i4"}
PART = {"doc": "i8", "tk": "i8", "group": "u8", "size": "u1", "n": "i4"}
SPOT = {"pos": "i8", "reach": "i4"}
SPAN = {"doc": "i8", "tk": "i8", "lo": "i4", "hi": "i4"}

Arrays = dict[str, np.ndarray]


def _pack(kinds: dict[str, str], columns: Arrays, cuts: np.ndarray) -> list[bytes]:
    """A binary for each stretch that begins at ``cuts``: its columns as planes of bytes, without planes that are zero."""
    n = len(columns["doc" if "doc" in kinds else "pos"])
    if not n:
        return []
    arrays = [np.ascontiguousarray(columns[c], k) for c, k in kinds.items()]
    differences = np.diff(arrays[0], prepend=arrays[0][:1])
    differences[cuts] = arrays[0][cuts]
    there, planes = [], []
    for x in [differences, *arrays[1:]]:
        used = np.bitwise_or.reduce(x, keepdims=True).view(np.uint8) != 0
        there.append(used)
        planes += [x.view(np.uint8).reshape(n, -1)[:, k] for k in np.flatnonzero(used)]
    head, planes = np.packbits(np.concatenate(there)).tobytes(), np.stack(planes)
    return [head + planes[:, a:b].copy().data for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), n], strict=True)]


def _unpack(kinds: dict[str, str], packed: list[bytes]) -> Arrays:
    """The columns of all stretches, one behind the other."""
    width = [np.dtype(k).itemsize for k in kinds.values()]
    head = -(-sum(width) // 8)
    there = [np.unpackbits(np.frombuffer(p, np.uint8, head))[: sum(width)].astype(bool) for p in packed]
    sizes = np.array([(len(p) - head) // np.count_nonzero(t) for p, t in zip(packed, there, strict=True)], np.int64)
    planes = np.zeros((sum(width), sizes.sum()), np.uint8)
    begin = np.cumsum(sizes) - sizes
    for p, t, a, n in zip(packed, there, begin.tolist(), sizes.tolist(), strict=True):
        planes[t, a : a + n] = np.frombuffer(p, np.uint8, offset=head).reshape(-1, n)
    out, at = {}, 0
    for (c, k), w in zip(kinds.items(), width, strict=True):
        out[c] = np.ascontiguousarray(planes[at : at + w].T).view(k).ravel()
        at += w
    if packed:
        first = next(iter(kinds))
        total = np.cumsum(out[first])
        out[first] = total - np.repeat(total[begin] - out[first][begin], sizes)
    return out


def _cuts(x: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)


def _take(columns: Arrays, at: np.ndarray) -> Arrays:
    return {c: x[at] for c, x in columns.items()}


def _join(frames: list[Arrays]) -> Arrays:
    return {c: np.concatenate([f[c] for f in frames]) for c in frames[0]}


def _fold(doc):  # a column or an array
    """What tells the bucket of a document, the same in Spark and numpy."""
    if isinstance(doc, Column):
        return doc.bitwiseXOR(F.shiftright(doc, 17)).bitwiseXOR(F.shiftright(doc, 31))
    return doc ^ (doc >> 17) ^ (doc >> 31)


def _by_document(kinds: dict[str, str], columns: Arrays, targets: int) -> tuple[np.ndarray, list[bytes]]:
    """Buckets of documents, and what goes to each."""
    bucket = np.mod(_fold(columns["doc"]), targets)
    order = np.lexsort([columns["doc"], bucket])
    cuts = _cuts(bucket := bucket[order])
    return bucket[cuts], _pack(kinds, _take(columns, order), cuts)


def _stretches(batch: pa.RecordBatch, by: list[str]) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """Neighbouring rows that agree in ``by``."""
    keys = [batch.column(c).to_numpy() for c in by]
    cuts = np.unique(np.concatenate([_cuts(k) for k in keys])).tolist()
    for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
        yield tuple(int(k[a]) for k in keys), batch.slice(a, b - a)


MOVED = "bucket int, data binary"


def _moved(bucket: np.ndarray, packed: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(packed, pa.binary())], ["bucket", "data"])


def _contexts(data: np.ndarray, bounds: np.ndarray) -> Iterator[Arrays]:
    """The contexts of texts in order, chunk by chunk; those of one text that are the same and touch are one."""
    k, n = 0, len(bounds) - 1
    while k < n:
        to = max(k + 1, int(np.searchsorted(bounds, bounds[k] + CHUNK, "right")) - 1)
        raw = data[bounds[k] : bounds[to]]
        for offset, piece in _pieces(raw) if to == k + 1 else [(0, raw)]:
            begin, end = (np.zeros(1, np.int64), np.array([len(piece)])) if to == k + 1 else (bounds[k:to] - bounds[k], bounds[k + 1 : to + 1] - bounds[k])
            row, start, size, anchor, name = _runs(piece, begin, end)
            # In order of name and place; names count here by their upper half, what that misses stays apart.
            order = np.sort((name >> np.uint64(32) << np.uint64(32)) | np.arange(len(name), dtype=np.uint64)).astype(np.uint32)
            r, s, x = row[order], start[order], name[order]
            head = np.ones(len(order), bool)
            head[1:] = (x[1:] != x[:-1]) | (r[1:] != r[:-1]) | (s[1:] - s[:-1] > LENGTH)
            at = np.flatnonzero(head)
            reach = np.zeros(len(order), np.int32)
            reach[order[at]] = s[np.append(at[1:], len(s)) - 1] - s[at] if len(at) else 0
            kept = np.sort(order[at])
            yield {"row": (row + k)[kept], "pos": (start - begin[row] + offset)[kept].astype(np.int32), "size": size[kept].astype(np.uint8), "anchor": anchor[kept], "name": name[kept], "reach": reach[kept]}
        k = to


#: What a crowded anchor has instead of a number of names: all that hold it cut their contexts into strings.
CROWDED = 2**31 - 1


def _group(bucket: np.ndarray | int, key: np.ndarray) -> np.ndarray:
    return key.astype(np.uint64) | (np.uint64(bucket) << np.uint64(32))


def _emit(bits: int, targets: int, crowd: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Contexts to the buckets of their anchors; to those of documents (below zero) the spans that a smaller
    document of the batch settles, and contexts of crowded anchors, for all of which one row of size 0
    goes to the anchor."""

    def out(held: list[Arrays], doc: np.ndarray, tag: np.ndarray) -> Iterator[pa.RecordBatch]:
        x = _join(held)
        if not (n := len(x["row"])):
            return
        order = np.sort((x["name"] >> np.uint64(24) << np.uint64(24)) | np.arange(n, dtype=np.uint64)).astype(np.int64) & 0xFFFFFF
        heads = _cuts(x["name"][order])
        d = doc[x["row"]]
        settled = np.zeros(n, bool)
        settled[order] = d[order] > np.repeat(d[order[heads]], np.diff(np.append(heads, n)))
        own = np.flatnonzero(settled)
        row, lo, hi = _merge(x["row"][own], x["pos"][own], x["pos"][own].astype(np.int64) + x["size"][own] + x["reach"][own])
        nothing = np.zeros(len(row), np.int64)
        answers = {"doc": doc[row], "tag": tag[row], "pos": lo, "size": nothing, "reach": hi - lo, "name": nothing, "group": nothing, "n": nothing}
        on = np.flatnonzero(~settled)
        bucket, key = x["anchor"][on] >> np.uint64(64 - bits), x["anchor"][on].astype(np.uint32)
        by = np.sort((x["anchor"][on] >> np.uint64(24) << np.uint64(24)) | np.arange(len(on), dtype=np.uint64)).astype(np.int64) & 0xFFFFFF
        anchor, row = x["anchor"][on][by], x["row"][on][by]
        cuts = _cuts(anchor)
        new = np.ones(len(by), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        many = np.add.reduceat(new, cuts, dtype=np.int64) > max(crowd, (x["row"][-1] - x["row"][0] + 1) // 16)
        columns = _take(x, on) | {"doc": d[on], "tag": tag[x["row"][on]], "key": key}
        if many.any():
            of = by[np.repeat(many, np.diff(np.append(cuts, len(by))))]
            crowded = _take(columns, of) | {"group": _group(bucket[of], key[of]), "n": np.full(len(of), CROWDED)}
            answers = _join([answers, crowded | {"pos": crowded["pos"].astype(np.int64)}])
            kept = np.ones(len(on), bool)
            kept[of] = False
            kept[heads := by[cuts[many]]] = True
            for c in ("name", "pos", "size", "reach"):
                columns[c][heads] = 0
            columns, bucket = _take(columns, np.flatnonzero(kept)), bucket[kept]
        yield _moved(*_settled(answers, targets))
        bucket = bucket.astype(np.uint16 if bits <= 16 else np.uint32)
        order = np.argsort(bucket, kind="stable")
        cuts = _cuts(bucket := bucket[order])
        yield _moved(bucket[cuts], _pack(PLACE, _take(columns, order), cuts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pa.array(np.argsort(batch.column("doc_id").to_numpy(), kind="stable")))
            doc, tag = batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy()
            held, size = [], 0
            for x in _contexts(*_bytes(batch.column("text"))):
                held.append(x)
                size += len(x["row"])
                if size > HELD:
                    yield from out(held, doc, tag)
                    held, size = [], 0
            if held:
                yield from out(held, doc, tag)

    return run


def _settled(answers: Arrays, targets: int) -> tuple[np.ndarray, list[bytes]]:
    bucket, packed = _by_document(ANSWER, answers, targets)
    return -1 - bucket, packed


def _judged(x: Arrays, bucket: int) -> Arrays:
    """The answers to contexts of a bucket of anchors."""
    order = np.sort((x["key"].astype(np.uint64) << np.uint64(32)) | np.arange(len(x["key"]), dtype=np.uint64)).astype(np.uint32)
    same = np.diff(x["key"][order]) == 0
    several = np.zeros(len(order), bool)
    several[1:] |= same
    several[:-1] |= same
    x = _take(x, order[several])
    x = _take(x, np.lexsort([x["doc"], x["name"], x["key"]]))
    if not (n := len(x["doc"])):
        return x | {"group": x["name"], "n": x["reach"]}
    keys = _cuts(x["key"])
    new = np.zeros(n, bool)
    new[keys] = True
    new[1:] |= x["name"][1:] != x["name"][:-1]
    kinds = np.flatnonzero(new)
    sizes = np.diff(np.append(keys, n))
    shared = np.minimum.reduceat(x["doc"], keys) < np.maximum.reduceat(x["doc"], keys)
    real = x["size"] > 0
    names = np.where(shared, np.add.reduceat(new & real, keys, dtype=np.int64), 0)
    names = np.repeat(np.where(np.logical_and.reduceat(real, keys), names, CROWDED), sizes)
    whole = x["doc"] > np.repeat(x["doc"][kinds], np.diff(np.append(kinds, n)))
    x["group"] = np.where(whole, np.uint64(0), _group(bucket, x["key"]))
    x["n"] = np.where(whole, 0, names).astype(np.int32)
    x["name"] = np.where(whole, np.uint64(0), x["name"])
    x["reach"] = np.where(whole, x["reach"] + x["size"], x["reach"])
    x["size"] = np.where(whole, np.uint8(0), x["size"])
    return _take(x, np.flatnonzero(real & (whole | (names > 1))))


def _judge(targets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Answers to the buckets of documents; rows arrive in order of bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, packed, held, size = -1, [], [], 0

        def judged() -> int:
            if packed:
                held.append({c: x for c, x in _judged(_unpack(PLACE, packed), now).items() if c in ANSWER})
                packed.clear()
                return len(held[-1]["doc"])
            return 0

        for batch in batches:
            for (bucket,), rows in _stretches(batch, ["bucket"]):
                if bucket < 0:
                    yield _moved(np.full(rows.num_rows, -1 - bucket), rows.column("data").to_pylist())
                    continue
                if bucket != now:
                    size += judged()
                    now = bucket
                    if size > HELD:
                        yield _moved(*_by_document(ANSWER, _join(held), targets))
                        held, size = [], 0
                packed += rows.column("data").to_pylist()
        judged()
        if held:
            yield _moved(*_by_document(ANSWER, _join(held), targets))

    return run


def _matched(rows: pa.RecordBatch, x: Arrays) -> tuple[np.ndarray, np.ndarray]:
    """Row and place in ``x`` of what ``x``, in order of doc, has for the documents of ``rows``."""
    ids = rows.column("doc_id")
    doc = ids.fill_null(0).to_numpy()
    lo = np.searchsorted(x["doc"], doc)
    n = np.where(ids.is_valid().to_numpy(zero_copy_only=False), np.searchsorted(x["doc"], doc, "right") - lo, 0)
    return np.repeat(np.arange(len(doc)), n), _ragged(lo, n)


class _Table:
    """What came packed for a bucket before its texts, in order of doc."""

    def __init__(self, kinds: dict[str, str], by: list[str]):
        self.kinds, self.by, self.bucket, self.packed, self.columns = kinds, by, -1, [], None

    def texts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Arrays]]:
        """Rows are in order of bucket and kind."""
        for batch in batches:
            for (bucket, kind), rows in _stretches(batch, ["bucket", "kind"]):
                if bucket != self.bucket:
                    self.bucket, self.packed, self.columns = bucket, [], None
                if not kind:
                    self.packed += rows.column("data").to_pylist()
                    continue
                if self.columns is None:
                    x = _unpack(self.kinds, self.packed)
                    self.columns, self.packed = _take(x, np.lexsort([x[c] for c in self.by])), []
                yield rows, self.columns


READ = "kind int, bucket int, data binary, bytes binary, spots binary"


def _strings(parts: Arrays, text: np.ndarray, spots: Arrays, most: int) -> tuple[Arrays, np.ndarray, Arrays, list[tuple[int, int, int, int]]]:
    """Contexts cut into their strings, dealt to as many groups as their names take; and the spans of strings
    that a smaller document among them holds too."""
    begin, first = np.cumsum(parts["size"], dtype=np.int64) - parts["size"], np.cumsum(parts["n_spots"]) - parts["n_spots"]
    smallest: dict[bytes, int] = {}
    rows, whole = [], []
    for k in range(len(begin)):
        part = text[begin[k] : begin[k] + int(parts["size"][k])].tobytes()
        doc, keys = int(parts["doc"][k]), -(-int(parts["n"][k]) // most)
        for j in range(len(part) - LENGTH + 1):
            string = part[j : j + LENGTH]
            smallest[string] = min(smallest.get(string, doc), doc)
            rows.append((k, j, doc, string, xxhash.xxh3_64_intdigest(string) % keys))
    kept = []
    for k, j, doc, string, key in rows:
        at = slice(first[k], first[k] + parts["n_spots"][k])
        if doc > smallest[string]:
            whole += [(doc, int(parts["tk"][k]), p + j, p + r + j + LENGTH) for p, r in zip(spots["pos"][at].tolist(), spots["reach"][at].tolist(), strict=True)]
        else:
            kept.append((k, j, key, string))
    k, j, key = (np.array([x[i] for x in kept], np.int64) for i in range(3))
    cut = _take(parts, k) | {"size": np.full(len(k), LENGTH, np.uint8)}
    cut["group"] = mix(cut["group"] + np.uint64(1) + key.astype(np.uint64))
    n = parts["n_spots"][k]
    at = _ragged(first[k], n)
    return cut, np.frombuffer(b"".join(x[3] for x in kept), np.uint8), {"pos": spots["pos"][at] + np.repeat(j, n), "reach": spots["reach"][at]}, whole


def _read(bits: int, targets: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Answers become spans (kind 0, to buckets of documents) and the bytes of wanted contexts (kind 1, to buckets of the sorter)."""

    def spans(x: Arrays) -> pa.RecordBatch:
        bucket, packed = _by_document(SPAN, x, targets)
        none = pa.nulls(len(packed), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(packed)), pa.int32()), pa.array(bucket, pa.int32()), pa.array(packed, pa.binary()), none, none], ["kind", "bucket", "data", "bytes", "spots"])

    def out(held: list[tuple[Arrays, np.ndarray, Arrays]]) -> Iterator[pa.RecordBatch]:
        parts, text, spots = _join([x for x, _, _ in held]), np.concatenate([x for _, x, _ in held]), _join([x for _, _, x in held])
        bucket = (parts["group"] >> np.uint64(64 - bits)).astype(np.int32)
        order = np.lexsort([parts["doc"], bucket])
        cuts = _cuts(bucket := bucket[order])
        size, n = parts["size"].astype(np.int64), parts["n_spots"]
        begin, first = np.cumsum(size) - size, np.cumsum(n) - n
        parts, size, n = _take(parts, order), size[order], n[order]
        text, spots = text[_ragged(begin[order], size)], _take(spots, _ragged(first[order], n))
        ends, cuts_of_spots = np.append(np.cumsum(size) - size, len(text))[np.append(cuts, len(size))], (np.cumsum(n) - n)[cuts]
        parts["n"] = n
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(cuts)), pa.int32()), pa.array(bucket[cuts], pa.int32()), pa.array(_pack(PART, parts, cuts), pa.binary()), pa.array([text[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary()), pa.array(_pack(SPOT, spots, cuts_of_spots), pa.binary())],
            ["kind", "bucket", "data", "bytes", "spots"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows, x in _Table(ANSWER, ["doc"]).texts(batches):
            data, bounds = _bytes(rows.column("data"))
            tk, doc = rows.column("tk").to_numpy(), rows.column("doc_id").fill_null(0).to_numpy()
            row, at = _matched(rows, x)
            mine = (x["tag"][at] == 0) | (x["tag"][at] == tk[row])
            row, at = row[mine], at[mine]
            full = x["n"][at] == 0
            r, a = row[full], at[full]
            order = np.lexsort([x["pos"][a], r])
            r, a = r[order], a[order]
            r, lo, hi = _merge(r, x["pos"][a], x["pos"][a].astype(np.int64) + x["reach"][a])
            if len(r):
                yield spans({"doc": doc[r], "tk": tk[r], "lo": lo, "hi": hi})
            row, at = row[~full], at[~full]
            if not len(row):
                continue
            order = np.lexsort([x["pos"][at], x["name"][at], row])
            row, at = row[order], at[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (x["name"][at][1:] != x["name"][at][:-1])
            heads = np.flatnonzero(new)
            r, a = row[heads], at[heads]
            parts = {"doc": doc[r], "tk": tk[r], "group": mix(x["group"][a]), "size": x["size"][a], "n": x["n"][a], "n_spots": np.diff(np.append(heads, len(row)))}
            text = data[_ragged(bounds[r] + x["pos"][a], x["size"][a].astype(np.int64))]
            spots = {"pos": x["pos"][at].astype(np.int64), "reach": x["reach"][at]}
            if (many := parts["n"] > most).any():
                some = lambda wanted: (_take(parts, np.flatnonzero(wanted)), text[np.repeat(wanted, parts["size"])], _take(spots, np.flatnonzero(np.repeat(wanted, parts["n_spots"]))))  # noqa: E731, B023
                *cut, whole = _strings(*some(many), most)
                if whole:
                    yield spans(dict(zip(SPAN, np.array(whole, np.int64).T, strict=True)))
                held.append(tuple(cut))
                size += len(cut[1])
                parts, text, spots = some(~many)
            held.append((parts, text, spots))
            size += len(text)
            if size > 8 * HELD:
                yield from out(held)
                held, size = [], 0
        if size:
            yield from out(held)

    return run


def _sort_blocks(targets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spans of contexts to the buckets of documents; rows arrive in order of bucket, blocks end at a group's end."""

    def sorted_(packed: list[tuple[bytes, bytes, bytes]]) -> Iterator[Arrays]:
        parts, spots = _unpack(PART, [p for p, _, _ in packed]), _unpack(SPOT, [s for _, _, s in packed])
        text = np.frombuffer(b"".join(t for _, t, _ in packed), np.uint8)
        size, n = parts["size"].astype(np.int64), parts["n"].astype(np.int64)
        begin, first = np.cumsum(size) - size, np.cumsum(n) - n
        order = np.argsort(parts["group"], kind="stable")
        groups = np.append(_cuts(parts["group"][order]), len(order))
        ends = np.cumsum(size[order])
        k = 0
        while k < len(groups) - 1:
            a = groups[k]
            k = max(k + 1, int(np.searchsorted(ends[groups[1:] - 1], ends[a] - size[order[a]] + BLOCK)) + 1)
            at = order[a : groups[min(k, len(groups) - 1)]]
            part, start = _hits(text[_ragged(begin[at], size[at])], size[at], parts["doc"][at])
            part, lo, hi = _merge(part, start, start + LENGTH)
            part = at[part]
            spot = _ragged(first[part], n[part])
            pos, owner = spots["pos"][spot], np.repeat(part, n[part])
            yield {"doc": parts["doc"][owner], "tk": parts["tk"][owner], "lo": pos + np.repeat(lo, n[part]), "hi": pos + spots["reach"][spot] + np.repeat(hi, n[part])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, packed, held, size = -1, [], [], 0
        for batch in batches:
            for (bucket,), rows in _stretches(batch, ["bucket"]):
                if bucket != now and packed:
                    held += sorted_(packed)
                    size += len(held[-1]["doc"])
                    packed = []
                    if size > HELD:
                        yield _moved(*_by_document(SPAN, _join(held), targets))
                        held, size = [], 0
                now = bucket
                packed += zip(*(rows.column(c).to_pylist() for c in ("data", "bytes", "spots")), strict=True)
        if packed:
            held += sorted_(packed)
        if held:
            yield _moved(*_by_document(SPAN, _join(held), targets))

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, x in _Table(SPAN, ["lo", "doc"]).texts(batches):
        data, bounds = _bytes(rows.column("data"))
        row, at = _matched(rows, x)
        mine = x["tk"][at] == rows.column("tk").to_numpy()[row]
        row, lo, hi = _merge(row[mine], x["lo"][at[mine]].astype(np.int64), x["hi"][at[mine]].astype(np.int64))
        n = rows.num_rows
        runs = np.bincount(row, minlength=n)
        removed = np.bincount(row, hi - lo, minlength=n).astype(np.int64)
        digests, view, k = [], memoryview(data), 0
        for r, count in enumerate(runs.tolist()):
            begin, end = int(bounds[r]), int(bounds[r + 1])
            digest, last = hashlib.sha256(), 0
            for a, b in zip(lo[k : k + count].tolist(), hi[k : k + count].tolist(), strict=True):
                digest.update(view[begin + last : begin + a])
                last = b
            digest.update(view[begin + last : end])
            digests.append(digest.hexdigest())
            k += count
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _unpack(SPAN, batch.column("data").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(x[c]) for c in SPAN], list(SPAN))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).withColumn("tk", F.xxhash64("text"))


def _beside(packed: DataFrame, texts: DataFrame, targets: int) -> DataFrame:
    """Packed columns and the texts they are for, in order of bucket."""
    bucket = F.pmod(_fold(F.coalesce("doc_id", F.monotonically_increasing_id())), F.lit(targets)).cast("int")
    left = packed.select("bucket", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("tk"), "data")
    return left.union(texts.select(bucket.alias("bucket"), F.lit(1).alias("kind"), "doc_id", "tk", F.col("text").alias("data"))).repartition("bucket").sortWithinPartitions("bucket", "kind")


def _packed_spans(docs: DataFrame, most: int) -> tuple[DataFrame, int]:
    """SPAN packed for each bucket of documents, and the number of those buckets."""
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits, targets = max(6, (4 * parallel - 1).bit_length()), 4 * parallel + 1
    texts = _texts(docs).where("doc_id is not null")
    # Only where ids repeat does a row have to be told from others of its id.
    repeated = not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    tagged = texts.select("doc_id", (F.col("tk") if repeated else F.lit(0).cast("long")).alias("tag"), "text")
    places = tagged.mapInArrow(_emit(bits, targets, min(CROWD, most)), MOVED).repartition("bucket").sortWithinPartitions("bucket")
    answers = materialize(places.mapInArrow(_judge(targets), MOVED), "repeat-answers")
    read = materialize(_beside(answers, texts, targets).mapInArrow(_read(bits, targets, most), READ), "repeat-parts")
    parts = read.where("kind = 1").select("bucket", "data", "bytes", "spots").repartition("bucket").sortWithinPartitions("bucket")
    return read.where("kind = 0").select("bucket", "data").union(parts.mapInArrow(_sort_blocks(targets), MOVED)), targets


def removal_spans(docs: DataFrame, most: int = MOST) -> DataFrame:
    """(doc, tk, lo, hi), tk the hash of the text: byte spans of each document to remove, not merged."""
    return _packed_spans(docs, most)[0].select("data").mapInArrow(_rows, "doc long, tk long, lo int, hi int")


def remove_repeats(docs: DataFrame, most: int = MOST) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans, targets = _packed_spans(docs, most)
    return _beside(spans, _texts(docs), targets).mapInArrow(_cut, RESULT)
