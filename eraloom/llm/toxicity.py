"""Toxicity by a support vector machine on a subsequence string kernel.

The kernel of two words sums over common 3-character subsequences, each weighted
by ``DECAY`` for every character that a gap skips, with spans up to 5 characters,
and is normalized to 1 for equal words. So an insult with inserted characters or
another ending stays close to the insult itself. Nystrom landmarks (words) turn
the kernel into finite features; a squared-hinge machine on them is trained on
sentences labelled by their document: a clean document's sentences are all
negative, a toxic document is represented by its worst sentences, found anew after
each fit. A sentence's value is that of its worst word, a document's that of its
worst sentence, made a probability by a logistic curve fitted on documents.

With landmarks fixed the machine is one weight per subsequence, so a word's value
is a sparse dot product, memoized per word; scoring is one pass without a shuffle.

Only rows with crc32(doc_id) modulo 5 other than 0 are learned from: about
``sample_docs`` labelled documents of each label, and of their rows with different
texts twice as many in all at most, drawn by hashes. Every word of that sample takes
part. Defined cases: null or blank texts hold no word and score like the mildest
document of the training sample; every text scores 0 when nothing is labelled, or
only one label occurs; repeated rows repeat their result and are learned from once;
texts are read whole; a doc_id with several labels counts as toxic if any says so,
null labels say nothing; equal texts score alike; extra columns are ignored.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eraloom.llm.sampling import fold, per_class
from eraloom.llm.text import map_rows
from eraloom.plans.scratch import broadcast_if_small, materialize

DECAY = 0.6
SPANS = [(a, b) for a in range(1, 4) for b in range(1, 5 - a)]
#: A word memo is emptied at this many entries, so that memory stays bounded.
MEMO = 100_000
_SPACED = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
RESULT = "doc_id long, held_out boolean, score double, predicted int"


def tokens(text: str | None) -> set[str]:
    """Distinct lower-case words; runs of single characters also count as one word."""
    low = (text or "").lower()
    found = {w.strip(string.punctuation) for w in low.split()}
    found.update("".join(m.split()) for m in _SPACED.findall(low))
    found.discard("")
    return found


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number, subsequence and weight of every word's distinct subsequences, normalized.

    A subsequence is named by its three code points, 21 bits each.
    """
    chars = np.frombuffer("".join(f"{w}\n" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    points, code = np.unique(chars, return_inverse=True)
    n_codes = len(points)
    if len(words) > 1 and n_codes**3 * len(words) > 2**62:  # keys of a word and its codes must fit a long
        half = len(words) // 2
        left, right = subsequences(words[:half]), subsequences(words[half:])
        return np.r_[left[0], right[0] + half], np.r_[left[1], right[1]], np.r_[left[2], right[2]]
    code = code.astype(np.int64)
    ends = chars == 10
    word = np.cumsum(ends) - ends
    keys, weights = [], []
    for a, b in SPANS:
        n = len(chars) - a - b
        if n <= 0:
            continue
        ok = np.flatnonzero((word[:n] == word[a + b :]) & ~ends[a + b :])
        keys.append(((word[ok] * n_codes + code[ok]) * n_codes + code[ok + a]) * n_codes + code[ok + a + b])
        weights.append(np.full(len(ok), DECAY ** (a + b - 2)))
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    weight = np.bincount(at, np.concatenate(weights), len(key))
    word = key // n_codes**3
    norm = np.sqrt(np.bincount(word, weight**2, len(words)))
    points = points.astype(np.int64)
    name = (points[key // n_codes**2 % n_codes] << 42) | (points[key // n_codes % n_codes] << 21) | points[key % n_codes]
    return word, name, weight / norm[word]


def kernel(left: list[str], right: list[str]) -> np.ndarray:
    """Normalized kernel values of two word lists."""
    out = np.zeros((len(left), len(right)), np.float32)
    rw, rk, rv = subsequences(right)
    order = np.argsort(rk, kind="stable")
    rw, rk, rv = rw[order], rk[order], rv[order]
    for k in range(0, len(left), 500):
        lw, lk, lv = subsequences(left[k : k + 500])
        lo, hi = np.searchsorted(rk, lk, "left"), np.searchsorted(rk, lk, "right")
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        np.add.at(out, (np.repeat(lw + k, n), rw[at]), np.repeat(lv, n) * rv[at])
    return out


def _machine(z: np.ndarray, y: np.ndarray, c: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """Squared-hinge support vector machine by Newton steps; the last weight is the bias.

    Least ``|w|**2 / 2 + sum(c * max(0, 1 - y * f)**2) / 2`` with a bias that is
    hardly penalized; sums run over blocks of rows. ``rows`` names the rows of z that
    y and c are for, which are never copied as a whole.
    """
    rows = np.arange(len(z)) if rows is None else rows
    size = z.shape[1] + 1
    w = np.zeros(size)
    ridge = np.eye(size)
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        left, right, some = ridge.copy(), np.zeros(size), False
        for k in range(0, len(rows), 4_096):
            part = z[rows[k : k + 4_096]].astype(float)
            part = np.hstack([part, np.ones((len(part), 1))])
            inside = y[k : k + 4_096] * (part @ w) < 1
            s, cost = part[inside], c[k : k + 4_096][inside]
            left += s.T @ (s * cost[:, None])
            right += s.T @ (y[k : k + 4_096][inside] * cost)
            some |= bool(inside.any())
        if not some:
            break
        new = np.linalg.solve(left, right)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y = 1 | x), with Platt's smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    design = np.column_stack([x, np.ones(len(x))])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        grad = design.T @ (p - t)
        hess = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


class Model:
    """One weight per subsequence of the landmarks, a bias, and the curve from value to probability."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.keys, self.weights, self.bias, self.slope, self.offset = keys, weights, bias, slope, offset
        self.floor = bias  # value of a text without words; the mildest document seen in training

    def values(self, words: list[str]) -> np.ndarray:
        out = []
        for k in range(0, len(words), 1_000):  # the subsequences of more words would stay in the worker's memory
            part = words[k : k + 1_000]
            word, key, value = subsequences(part)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            out.append(np.bincount(word[known], self.weights[at[known]] * value[known], len(part)) + self.bias)
        return np.concatenate(out) if out else np.empty(0)

    def probability(self, x: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * x + self.offset, -35, 35))))


def fit(rows: list[tuple[str, int]], landmarks: int = 192, rounds: int = 4, witnesses: int = 4, prior: float | None = None) -> Model | None:
    """Train on (text, toxic) pairs; None unless both labels occur. ``prior`` is the share
    of toxic rows where texts are scored, if the pairs are drawn in other shares."""
    place: dict[str, int] = {}
    bags, labels = [], []  # sentences as arrays of word numbers
    for text, label in rows:
        sentences = [np.fromiter((place.setdefault(w, len(place)) for w in sorted(s)), np.int64, len(s)) for s in map(tokens, _SENTENCE.split(text or "")) if s]
        if sentences:
            bags.append(sentences)
            labels.append(label)
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        return None
    words = list(place)
    whole = [np.unique(np.concatenate(b)) for b in bags]
    count = lambda label: np.bincount(np.concatenate([w for w, x in zip(whole, y, strict=True) if x == label]), minlength=len(words))
    toxic, clean = count(1), count(0)
    n1, n0 = y.sum(), len(y) - y.sum()
    gain = (np.log((toxic + 0.5) / (n1 + 1)) - np.log((clean + 0.5) / (n0 + 1))) * np.sqrt(toxic)
    long = np.array([len(w) > 2 for w in words])
    ranked = lambda by, ok: sorted(np.flatnonzero(ok).tolist(), key=lambda k: (-by[k], words[k]))
    marks = ranked(gain, long & (toxic > 0))[: landmarks // 2]
    marks += [k for k in ranked(clean, long & (clean > 0)) if k not in set(marks)][: landmarks - len(marks)]
    marks = [words[k] for k in marks]
    if not marks:
        return None
    values, vectors = np.linalg.eigh(kernel(marks, marks).astype(float))
    keep = values > 1e-3
    root = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)
    z = np.empty((len(words), root.shape[1]), np.float32)
    for k in range(0, len(words), 8_192):  # kernel values of all words at once would double the memory
        z[k : k + 8_192] = kernel(words[k : k + 8_192], marks) @ root
    negative = np.flatnonzero(clean)
    # Witnesses are words that mark toxic documents and occur in two at least, if any do.
    hopeful = long & (toxic > 1) & (gain > 0)
    hopeful = hopeful if hopeful.any() else long & (toxic > 0)
    members = [[k for s in b if len(k := s[hopeful[s]])] for b, label in zip(bags, y, strict=True) if label]
    members = [b for b in members if b]
    if not members:
        return None
    worth = gain
    for _ in range(rounds):
        # Worst sentences of each toxic document, by the words that make them so.
        best = np.array([max(worth[w].max() for w in b) for b in members])
        floor = max(np.quantile(best, 0.05), 0.0)
        picks = [k for b in members for k in sorted({k for w in b for k in w.tolist() if worth[k] > floor}, key=lambda k: (-worth[k], words[k]))[:witnesses]]
        hot, counts = np.unique(picks or [int(np.where(hopeful, worth, -np.inf).argmax())], return_counts=True)
        w = _machine(z, np.r_[np.ones(len(hot)), -np.ones(len(negative))], np.r_[counts * (n0 / n1), clean[negative].astype(float)], np.r_[hot, negative])
        worth = np.concatenate([z[k : k + 8_192] @ w[:-1] for k in range(0, len(z), 8_192)]) + w[-1]
    alpha = root @ w[:-1]
    word, key, value = subsequences(marks)
    keys, at = np.unique(key, return_inverse=True)
    model = Model(keys, np.bincount(at, alpha[word] * value, len(keys)), float(w[-1]), 1.0, 0.0)
    worst = np.array([worth[b].max() for b in whole])
    model.slope, model.offset = _logistic(worst, y)
    if prior is not None and 0 < prior < 1:
        model.offset += float(np.log(prior / (1 - prior)) - np.log(n1 / n0))
    model.floor = float(worst.min())
    return model


def _scorer(model: Model | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, float] = {}
        for pdf in batches:
            scores = []
            for k in range(0, len(pdf), 200):
                bags = [tokens(t) for t in pdf["text"].iloc[k : k + 200]]
                if model is None:
                    scores += [0.0] * len(bags)
                    continue
                if len(memo) > MEMO:
                    memo.clear()
                new = list(set().union(*bags).difference(memo))
                memo.update(zip(new, model.values(new).tolist(), strict=True))
                scores += [model.probability(max(map(memo.__getitem__, b), default=model.floor)) for b in bags]
            yield pd.DataFrame({"score": scores, "predicted": [int(s >= 0.5) for s in scores]})

    return run


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = 1_000) -> Model | None:
    """Fit on about ``sample_docs`` labelled documents of each class outside fold 0."""
    marked = labels.where(F.col("toxic").isNotNull() & (fold() != 0)).groupBy("doc_id").agg(F.max((F.col("toxic").cast("int") > 0).cast("int")).alias("toxic"))
    picked = materialize(per_class(marked, "toxic", sample_docs), "toxic-sample")
    prior = marked.agg(F.avg("toxic").alias("p")).first()["p"]
    rows = docs.select("doc_id", "text").join(broadcast_if_small(picked, picked.count(), 10 * sample_docs), "doc_id")
    texts = materialize(rows.withColumn("key", F.xxhash64("text")).dropDuplicates(["doc_id", "key"]), "toxic-texts")
    drawn = F.pmod(F.xxhash64("doc_id", "key"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    rows = texts.where(drawn < 4 * sample_docs / max(texts.count(), 1)).collect()
    return fit([(r["text"], r["toxic"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"] or ""))], prior=prior)


def judge(docs: DataFrame, labels: DataFrame, sample_docs: int = 1_000) -> DataFrame:
    """``score`` with each row's ``key``, the hash of its text."""
    model = train(docs, labels, sample_docs)
    rows = docs.select("doc_id", "text", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), F.xxhash64("text").alias("key"))
    return map_rows(rows, ["doc_id", "held_out", "key"], _scorer(model), f"{RESULT}, key long")


def score(docs: DataFrame, labels: DataFrame, sample_docs: int = 1_000) -> DataFrame:
    """doc_id, held_out, score in [0, 1] and predicted for every row."""
    return judge(docs, labels, sample_docs).drop("key")
