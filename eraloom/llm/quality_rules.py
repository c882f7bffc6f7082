"""Quality rules as a short-circuit cascade.

The counts of the result are computed for every text. The rules go beyond them: each
does work of its own (patterns, compression, word and phrase counts) to reject a text.
On a sample of ``sample_rows`` rows (the sample steers only the order, never a verdict)
every rule runs on every sampled text, apart from the others; its mean time and the
share it rejects give rejections per second, and rules run in falling order of that
ratio. A text leaves the cascade at its first rejection, so costly rules see only what
cheap ones let through; what one rule has derived from a text (line and word hashes)
serves the next. A text is kept when no rule rejects it, which no order can change.

The pass over the data is one Arrow-batched map without a shuffle.

Defined cases: a null text counts as empty; a text without words fails the base
rules unless ``least_words`` is 0, and no other rule applies to it; repeated rows
repeat their result; texts are read whole, whatever their length; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import time
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eraloom.llm.text import WordHash, map_rows, windows, word_hashes

_SYMBOLS = re.compile(r"[#*$%&|<>]")
#: A whole word without any letter.
_UNLETTERED = re.compile(r"(?<![^ \t-\r])(?:(?![ \t-\r])[\W\d_])+(?![^ \t-\r])")
_BULLETS = (b"-", b"*", b"\xe2\x80\xa2")
_WINDOW = 8
RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"


class Text:
    """One text with the counts of the result, and what rules derive from it when asked."""

    def __init__(self, text: str | None, memo: WordHash):
        self.text = text or ""
        self.raw = raw = self.text.encode("utf-8", "surrogatepass")
        self.tokens = raw.split()
        self.n_words = len(self.tokens)
        self.word_chars = len(self.text) - sum(map(self.text.count, " \t\n\r\x0b\x0c"))
        self.n_symbols = len(_SYMBOLS.findall(self.text))
        self.lines = [x for x in raw.split(b"\n") if x.split()]
        self.n_dup_lines = len(self.lines) - len(set(self.lines))
        self.hashes = word_hashes(self.tokens, memo)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside an 8-word window that the text holds twice or more."""
        w = windows(self.hashes, _WINDOW)
        if len(w) < 2:
            return 0
        order = np.argsort(w, kind="stable")
        same = w[order[1:]] == w[order[:-1]]
        if not same.any():
            return 0
        again = np.zeros(len(w), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        edge = np.zeros(self.n_words + 1, np.int64)
        starts = np.flatnonzero(again)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + _WINDOW, -1)
        return int((np.cumsum(edge)[:-1] > 0).sum())

    @cached_property
    def top_word(self) -> int:
        """How often the commonest word occurs."""
        return int(np.unique(self.hashes, return_counts=True)[1].max())

    @cached_property
    def top_pair(self) -> int:
        """How often the commonest pair of consecutive words occurs."""
        w = windows(self.hashes, 2)
        return int(np.unique(w, return_counts=True)[1].max()) if len(w) else 0

    @cached_property
    def line_starts(self) -> Counter:
        """Lines by their first word."""
        return Counter(x.split(None, 1)[0] for x in self.lines)


#: Rules of the cascade beyond the base ones: name and test for rejection.
RULES: dict[str, Callable[[Text], bool]] = {
    "symbols": lambda t: t.n_symbols > 0.3 * t.n_words,
    "word_length": lambda t: not 2 <= t.word_chars / t.n_words <= 15,
    "duplicate_lines": lambda t: t.n_dup_lines > 0.3 * len(t.lines),
    "top_word": lambda t: t.top_word > 0.3 * t.n_words,
    "top_pair": lambda t: t.top_pair > 0.2 * t.n_words,
    "unlettered_words": lambda t: len(_UNLETTERED.findall(t.text)) > 0.3 * t.n_words,
    "bullet_lines": lambda t: sum(n for w, n in t.line_starts.items() if w.startswith(_BULLETS)) > 0.9 * len(t.lines),
    "cut_lines": lambda t: sum(x.rstrip().endswith((b"...", b"\xe2\x80\xa6")) for x in t.lines) > 0.3 * len(t.lines),
    "compressible": lambda t: 8 * len(zlib.compress(t.raw, 1)) < len(t.raw),
}
#: Derived values that a rule may leave behind for another.
_DERIVED = ("top_word", "top_pair", "line_starts")


def _timed(rules: Mapping[str, Callable[[Text], bool]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHash()
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                t = Text(text, memo)
                for name, test in rules.items() if t.n_words else ():
                    for derived in _DERIVED:
                        t.__dict__.pop(derived, None)
                    began = time.perf_counter()
                    rejected = test(t)
                    out.append((name, time.perf_counter() - began, int(rejected)))
            yield pd.DataFrame(out, columns=["rule", "seconds", "rejected"])

    return run


def rule_order(docs: DataFrame, sample_rows: int = 2_000, rules: Mapping[str, Callable[[Text], bool]] = RULES) -> list[str]:
    """Rule names by estimated rejections per second, highest first."""
    sample = docs.select("text").sample(fraction=min(1.0, sample_rows / max(docs.count(), 1)), seed=17)
    seen = sample.mapInPandas(_timed(rules), "rule string, seconds double, rejected int")
    stats = {r["rule"]: (r["cost"], r["share"]) for r in seen.groupBy("rule").agg(F.avg("seconds").alias("cost"), F.avg("rejected").alias("share")).collect()}
    return sorted(rules, key=lambda name: -stats[name][1] / max(stats[name][0], 1e-9) if name in stats else 0.0)


def _cascade(tests: list[Callable[[Text], bool]], least_words: int, most_repeated: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHash()
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                t = Text(text, memo)
                failed = t.n_words < least_words or 100 * t.n_repeat_words > most_repeated * t.n_words
                kept = not failed and not (t.n_words and any(test(t) for test in tests))
                rows.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, kept))
            yield pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])

    return run


def apply_rules(docs: DataFrame, sample_rows: int = 2_000, least_words: int = 20, most_repeated: int = 30, rules: Mapping[str, Callable[[Text], bool]] = RULES) -> DataFrame:
    """Counts and verdict for every row; ``most_repeated`` is a percentage of the words."""
    order = rule_order(docs, sample_rows, rules)
    return map_rows(docs.select("doc_id", "text"), ["doc_id"], _cascade([rules[name] for name in order], least_words, most_repeated), RESULT)
