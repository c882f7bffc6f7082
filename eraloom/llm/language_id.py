"""Language identification by cross-parsing entropy.

A suffix automaton is built from labelled text of each language. A text's letters,
lower-cased, words joined by one space, are parsed against each automaton into
longest matches, greedily from left to right and across words; the language that
needs the fewest phrases per character wins (all languages parse the same
characters, so the counts compare directly).

Automata are built in each worker from a bounded sample of labelled rows
(``docs_per_language`` whole texts of each language outside fold 0, drawn by a hash);
a parse is one dictionary lookup per character and language. One pass, no shuffle.

Defined cases: texts that are null or hold no letter are ``und`` with score 0;
with no labelled row at all every text is; ties go to the language first in
order; a single learned language wins with score 1. Rows whose crc32(doc_id)
modulo 5 is 0, or whose doc_id is null, are never learned from. Repeated rows
repeat their result; extra columns are ignored; texts are parsed whole.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eraloom.llm.sampling import fold, per_class
from eraloom.llm.text import map_rows

RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


@functools.lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(k).isalpha() for k in range(0x110000)), bool, 0x110000)


def letters(text: str | None) -> str:
    """The lower-cased letters of a text, other runs between them as one space."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = _letter_table()[points]
    if not known.any():
        return ""
    first, last = known.argmax(), len(known) - known[::-1].argmax()
    points, known = points[first:last], known[first:last]
    keep = known.copy()
    keep[1:] |= known[:-1]
    return np.where(known, points, 32)[keep].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")


def suffix_automaton(text: str) -> dict[str, dict]:
    """The start of the smallest automaton of all substrings; a state maps each character
    to the next state."""
    go: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(go)
        go.append({}), link.append(0), length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(go)
                go.append(go[q].copy()), link.append(link[q]), length.append(length[p] + 1)
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    for state in go:
        for c, to in state.items():
            state[c] = go[to]
    return go[0]


def phrases(start: dict[str, dict], text: str) -> int:
    """Number of longest matches in a greedy parse; an unseen character is a phrase."""
    count, here = 0, start
    for c in text:
        following = here.get(c)
        if following is None:
            count += here is not start
            following = start.get(c)
            if following is None:
                count += 1
                following = start
        here = following
    return count + (here is not start)


@functools.lru_cache(maxsize=1)
def _automata(training: tuple[tuple[str, str], ...]) -> list[dict[str, dict]]:
    return [suffix_automaton(text) for _, text in training]


def _predictor(training: tuple[tuple[str, str], ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, automata = [name for name, _ in training], _automata(training)
        for pdf in batches:
            langs, scores = [], []
            for text in pdf["text"]:
                only = letters(text) if names else ""
                if not only:
                    langs.append("und"), scores.append(0.0)
                    continue
                counts = np.array([phrases(a, only) for a in automata])
                best = int(counts.argmin())
                langs.append(names[best])
                scores.append(float(1 / ((counts[best] / counts) ** 16).sum()))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return run


def training_text(docs: DataFrame, docs_per_language: int = 24) -> tuple[tuple[str, str], ...]:
    """Language and learned letters of about ``docs_per_language`` whole labelled texts
    of each language outside fold 0. A line end, which no parsed text has, parts texts."""
    labelled = docs.select("doc_id", "text", "lang").where((fold() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    found: dict[str, list[str]] = {}
    labelled = labelled.withColumn("key", F.xxhash64("text"))  # repeats of a row are learned once
    for r in sorted(per_class(labelled, "lang", docs_per_language, ["doc_id", "key"]).dropDuplicates(["lang", "doc_id", "key"]).collect(), key=lambda r: (r["lang"], r["doc_id"], r["text"])):
        found.setdefault(r["lang"], []).append(letters(r["text"]))
    return tuple((k, "\n".join(found[k])) for k in sorted(found) if any(found[k]))


def identify(docs: DataFrame, docs_per_language: int = 24) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row."""
    training = training_text(docs, docs_per_language)
    rows = docs.select("doc_id", "text", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"))
    return map_rows(rows, ["doc_id", "held_out"], _predictor(training), RESULT)
