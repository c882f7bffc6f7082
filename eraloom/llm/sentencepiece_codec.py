"""Exact merge-type SentencePiece encoding by backtracking, and decoding.

A piece sequence is the merge encoding of a string exactly when every piece
re-merges to itself and every two neighbours stay apart when their concatenation
is merged again. The encoder walks a string with the longest vocabulary matches
that an Aho-Corasick automaton finds, accepts a piece if it is compatible with
the one before, otherwise tries the next shorter match, and steps back when none
is left; a bitfield of positions known to fail keeps that from repeating.

Merges cross neither the start of a run of word marks nor a character outside
the vocabulary, so a text falls into independent units, and a bounded memo of
unit encodings serves most of it. Work is one pass over the rows in Arrow
batches: no shuffle, and a lost task is simply rerun.

The encoder covers merge-type models that leave text as it is but for a word mark in
front and for spaces. A model of another kind is refused: every encoder first encodes
``PROBES`` as the library does, or raises. Models are shipped and cached by content.

Defined cases: null and empty texts encode to the end id alone and decode to an
empty string; repeated rows repeat their result; every text is encoded whole,
whatever its length; other columns pass through ``encode`` untouched by name.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame

from eraloom.llm.text import map_rows

MARK = "▁"
#: Memos are emptied at this many entries, and hold no part of over LONG characters, so that memory stays bounded:
#: a worker keeps them beside the executor's heap as long as it lives, so an entry is one string or one number.
MEMO = 300_000
LONG = 64
#: Texts that models with other normalization, prefixes, spaces or piece types encode differently.
PROBES = ["Hello world", "ABC Straße ÉCOLE", "ﬁ ① Å é ｆｕｌｌ", " a  b   c ", "tab\tline\nend\r\n", "日本語 текст عربي 😀", "aaaaabbbbb 12345 don't", "\u00a0\u3000\u200bx", "internationalization misunderstandings", "\u2581x \u2581\u2581"]
#: Texts of one decode call hold about so many ids.
DECODE_IDS = 100_000

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Encoder:
    """Backtracking encoder over one merge-type model; ids equal the library's."""

    def __init__(self, proto: bytes):
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.end = sp.eos_id()
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.fallback = sp.is_byte(self.bytes[0])
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
                piece = sp.id_to_piece(i)
                self.score[piece], self.ids[piece] = sp.get_score(i), i
        self.chars = {c for c in self.ids if len(c) == 1}
        self.matcher = ahocorasick.Automaton()
        for piece, i in self.ids.items():  # a piece that does not re-merge to itself occurs in no encoding
            if self.merge(piece) == [piece]:
                self.matcher.add_word(piece, (len(piece) - 1, i))
        self.matcher.make_automaton()
        self.pairs: dict[int, bool] = {}
        known = "".join(sorted(map(re.escape, self.chars - {MARK})))
        self.units = re.compile(f"{MARK}+[{known}]*|[{known}]+|[^{known}{MARK}]+")
        self.plain, self.marked = Memo(self, ""), Memo(self, MARK)
        self.newline = self.plain["\n"]
        for text in PROBES:
            if self.encode(text)[:-1] != sp.encode(text):
                raise ValueError("the model is not of the merge type, or normalizes its input")

    def merge(self, text: str) -> list[str]:
        """Merge by score, leftmost first: the definition, used on one or two pieces at a time."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def apart(self, left: int, right: int) -> bool:
        """Whether two neighbours survive re-merging their concatenation."""
        ok = self.pairs.get(left << 32 | right)
        if ok is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            pair = [self.sp.id_to_piece(left), self.sp.id_to_piece(right)]
            ok = self.pairs[left << 32 | right] = self.merge("".join(pair)) == pair
        return ok

    def pieces(self, unit: str) -> list[int]:
        """Ids of the merge encoding of a unit made of vocabulary characters."""
        n = len(unit)
        ends: list[list[tuple[int, int]]] = [[] for _ in unit]  # match ends and ids by start, shortest first
        for last, (back, i) in self.matcher.iter(unit):
            ends[last - back].append((last + 1, i))
        known, failed = self.pairs.get, 0  # bit p: no encoding goes through position p
        out: list[int] = []
        steps: list[tuple[int, int]] = []  # start of each piece, number of shorter matches left
        at, left = 0, len(ends[0])
        while at < n:
            options = ends[at]
            while left:
                left -= 1
                end, piece = options[left]
                if failed >> end & 1:
                    continue
                if out and not ((ok := known(out[-1] << 32 | piece)) or ok is None and self.apart(out[-1], piece)):
                    continue
                out.append(piece)
                steps.append((at, left))
                at = end
                left = len(ends[at]) if at < n else 0
                break
            else:
                failed |= 1 << at
                if not out:
                    return list(map(self.ids.__getitem__, self.merge(unit)))
                out.pop()
                at, left = steps.pop()
        return out

    def unit(self, unit: str) -> tuple[int, ...]:
        """Ids of one unit."""
        if unit[0] in self.chars:
            return tuple(self.pieces(unit))
        if self.fallback:
            return tuple(map(self.bytes.__getitem__, unit.encode()))
        return (self.sp.unk_id(),) * len(unit)

    def parts(self, text: str) -> list[str]:
        """Ids of a text's parts, each as decimals joined by spaces, in order and without the end id.

        Parts are cut at single spaces and line ends; where spaces come in runs
        they belong to one unit, and the text is cut into units instead.
        """
        if not text:
            return []
        if text[0] == " " or "  " in text or MARK in text:
            return [self.plain[u] for u in self.units.findall(MARK + text.replace(" ", MARK))]
        lines = text.split("\n")
        marked = self.marked.__getitem__
        out = list(map(marked, lines[0].split(" ")))
        for line in lines[1:]:
            first, *rest = line.split(" ")
            out.append(self.newline)
            if first:
                out.append(self.plain[first])
            out += map(marked, rest)
        return out

    def listed(self, text: str | None) -> str:
        """Ids of a whole text, end id included, as decimals joined by spaces."""
        return " ".join([*self.parts(text or ""), str(self.end)])

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text, end id included."""
        return list(map(int, self.listed(text).split(" ")))


class Memo(dict):
    """Bounded memo from a part to its ids, as decimals joined by spaces."""

    def __init__(self, encoder: Encoder, prefix: str):
        self.encoder, self.prefix = encoder, prefix

    def __missing__(self, part: str) -> str:
        if len(self) >= MEMO:
            self.clear()
        encoder = self.encoder
        found = " ".join(map(str, chain.from_iterable(map(encoder.unit, encoder.units.findall(self.prefix + part)))))
        if len(part) <= LONG:
            self[part] = found
        return found


@functools.lru_cache(maxsize=1)
def _encoder(proto: bytes) -> Encoder:
    """One encoder for a worker process, so that its memos serve all its tasks."""
    return Encoder(proto)


def _digests(model: Broadcast):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(model.value)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for pdf in batches:
            counts, hashes, decoded, waiting, held = [], [], [], [], 0
            for text in pdf["text"]:
                found = encoder.listed(text)
                ids = list(map(int, found.split(" ")))
                counts.append(len(ids))
                hashes.append(sha(found))
                waiting.append(ids)
                held += counts[-1]
                if held >= DECODE_IDS:
                    decoded += map(sha, encoder.sp.decode(waiting, num_threads=1))
                    waiting, held = [], 0
            decoded += map(sha, encoder.sp.decode(waiting, num_threads=1)) if waiting else []
            yield pd.DataFrame({"n_tokens": counts, "ids_sha256": hashes, "decoded_sha256": decoded})

    return run


def _ids(model: Broadcast, decode: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(model.value)
        for pdf in batches:
            rows = [encoder.encode(t) for t in pdf["text"]]
            out = pd.DataFrame({"ids": rows})
            if decode:
                out["decoded"] = encoder.sp.decode(rows, num_threads=1) if rows else []
            yield out

    return run


def _ship(docs: DataFrame, model: str) -> Broadcast:
    """The model's bytes on all executors; a model that the encoder does not cover raises here."""
    with open(model, "rb") as f:
        proto = f.read()
    Encoder(proto)
    return docs.sparkSession.sparkContext.broadcast(proto)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and the ids of each whole text, end id included."""
    return map_rows(docs.select("doc_id", "text"), ["doc_id"], _ids(_ship(docs, model), False), "doc_id long, ids array<int>")


def encode_decode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids and the library's decoding of those ids."""
    return map_rows(docs.select("doc_id", "text"), ["doc_id"], _ids(_ship(docs, model), True), "doc_id long, ids array<int>, decoded string")


def round_trip_digests(docs: DataFrame, model: str) -> DataFrame:
    """Per row: doc_id, number of ids, SHA-256 of the ids and of the decoded text."""
    return map_rows(docs.select("doc_id", "text"), ["doc_id"], _digests(_ship(docs, model)), RESULT)
