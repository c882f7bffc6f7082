from __future__ import annotations

import hashlib
import random
from collections import Counter
from itertools import accumulate, pairwise

import numpy as np
import pytest

from eraloom.llm import token_alignment, vector_codes
from eraloom.llm.queries import tokenizer_model

VECTORS = "vec_id long, embedding array<float>, label string, code string"


def plain_codes(rows, parts, entries, rounds):
    """(code, error) per kept row and the digest, by comparing every part with every entry."""
    kept = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and len(r[1]) % parts == 0]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    x = np.floor(1024 * np.array([np.float32(r[1]) for r in kept], np.float64)).clip(-(2**27), 2**27).astype(np.int64).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    for step in range(rounds + 1):
        d = ((x[:, :, None] - books[None]) ** 2).sum(3)
        near = d.argmin(2)
        if step == rounds:
            break
        for p in range(parts):
            for k in set(near[:, p]):
                own = x[near[:, p] == k, p]
                books[p, k] = [int(s) // len(own) for s in own.sum(0)]
    text = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    errors = np.take_along_axis(d, near[:, :, None], 2)[:, :, 0].sum(1)
    return [(r[0], "".join(f"{k:02x}" for k in n), int(e), r[2]) for r, n, e in zip(kept, near, errors, strict=True)], text


@pytest.mark.parametrize(("parts", "entries"), [(4, 16), (2, 256)])
def test_vector_codes(spark, parts, entries):
    rng = np.random.default_rng(7)
    rows = [(k, (rng.normal(size=8) / 7).astype(np.float32).tolist(), f"l{k % 5}") for k in range(600)]
    rows += [(1000 + k, [0.25] * 8, None) for k in range(300)]  # one vector in a third of the rows
    rows += [(2**62 + k, [round(v, 1) for v in rng.normal(size=8).tolist()], None) for k in range(60)]
    rows += [(None, rng.normal(size=8).tolist(), "l1"), (None, [1e30, -1e30] + [0.0] * 6, "l2"), (5, rows[5][1], "l0"), (6, rows[9][1], "l1")]
    rows += [(-1, None, "x"), (-2, [], "x"), (-3, [1.0] * 7 + [None], "x"), (-4, [1.0] * 7 + [float("nan")], "x"), (-5, [1.0] * 7 + [float("inf")], "x"), (3000, [1.0] * 12, "x"), (3001, [1.0] * 7, "x")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], VECTORS).repartition(5)
    expected, digest = plain_codes(rows, parts, entries, 3)
    totals = {}
    for _, _, e, label in expected:
        totals[label] = totals.get(label, 0) + e
    got = vector_codes.compress(df, parts, entries, 3)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, c, e, totals[label] if totals[label] < 2**63 else None, digest) for i, c, e, label in expected), key=repr)
    assert vector_codes.compress(df.limit(0)).count() == 0


def test_vector_codes_with_many_labels(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "LABELS", 3)
    rows = [(k, [k / 9, (k * 7 % 5) / 3, 0.5, -k / 4], "hot" if k % 3 else f"l{k}") for k in range(90)]
    got = {r["vec_id"]: r for r in vector_codes.compress(spark.createDataFrame([(*r, "") for r in rows], VECTORS), 2, 8, 2).collect()}
    assert len(got) == 90
    hot = sum(got[k]["error"] for k in range(90) if k % 3)
    assert all(got[k]["label_error"] == (hot if k % 3 else got[k]["error"]) for k in range(90))


def test_balls_own_and_lists_shrink():
    """Far clusters: whole balls go to their entry without looking at points, and copies form one ball."""
    rng = random.Random(3)
    x = np.array([[1000 * (k % 6) + rng.randint(0, 3), rng.randint(0, 3)] for k in range(3000)])
    order, nodes = vector_codes.build_tree(x)
    assert sorted(order.tolist()) == list(range(3000)) and nodes[-1]["end"] - nodes[-1]["start"] == 3000
    book, looked = np.array([[1000 * k, 1] for k in range(6)] + [[10**6, 10**6]]), []

    class Watched(np.ndarray):
        def __matmul__(self, other):
            looked.append(len(self))
            return np.ndarray.__matmul__(self.view(np.ndarray), other)

    sums, counts = vector_codes.assign(x[order].view(Watched), nodes, book)
    assert counts.tolist() == [500] * 6 + [0] and (sums[:6].sum(0) == x.sum(0)).all() and not looked
    order, nodes = vector_codes.build_tree(np.ones((5000, 3), np.int64))
    assert len(nodes) == 1 and nodes[0]["radius"] == 0


FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def plain_alignment(texts):
    """Per text its contract columns, from token spans by the libraries and every overlapping pair."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side, b_side = Tokenizer.from_file(tokenizer_model(FILES[0])), sentencepiece.SentencePieceProcessor(model_file=tokenizer_model(FILES[1]))
    a_side.encode_special_tokens = True
    alphabet = token_alignment.byte_alphabet()
    found, counts = [], Counter()
    for text in texts:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        bytes_a = [bytes(alphabet[c] for c in a_side.id_to_token(x)) for x in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b_side.is_byte(x) else p.replace("\u2581", " ").encode() for x in b for p in [b_side.id_to_piece(x)]]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            found.append(None)
            continue
        spans = [list(pairwise(accumulate(map(len, side), initial=0))) for side in (bytes_a, bytes_b)]
        linked = [(x, y) for x, (s, e) in zip(a, spans[0], strict=True) for y, (t, f) in zip(b, spans[1], strict=True) if s < f and t < e]
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = []
        for low, high in pairwise([0, *common]):
            groups.append("|".join(",".join(str(x) for x, (s, e) in zip(ids, side, strict=True) if low <= s and e <= high) for ids, side in zip((a, b), spans, strict=True)))
        found.append((len(a), len(b), groups, linked))
        counts.update(linked)
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, linked = f
        out.append((n_a, n_b, len(groups), len(linked), sum(counts[p] == most[p[1]] for p in linked), sum(counts[p] for p in linked), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def odd_texts():
    rng = random.Random(9)
    words = ["the", "of", "internationalization", "Straße", "naïve", "日本語", "don't", "x\ny", "12345", "😀", "end.\nStart", "αβγ", "thheouble", "<|endoftext|>", "</s>", "a-b/c"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(40)]
    texts += [None, "", " ", "a", "\n", " lead", "trail ", "two  spaces", "tab\tx", "x \n y", "x\n\ny z", "a\u2581b c", "\u2581", "nb\u00a0sp", "z\u200bw \u2028 q", "\x00\x01 \x7f", "e\u0301 é", "fi\ufb01 ①", "x" * 3000, "the " * 2500 + "end", "\u3000wide \u0085 next", "\ufeffbom x"]
    return texts + texts[:5]


def test_token_alignment(spark, monkeypatch):
    texts = odd_texts()
    ids = [None, 2**62 + 1, 2**53 + 1, *range(len(texts) - 3)]
    rows = [(i, t, "clash", "clash") for i, t in zip(ids, texts, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk string, codes string").repartition(3)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected = sorted(((i, *r) for i, r in zip(ids, plain_alignment(texts), strict=True)), key=repr)
    for size in (token_alignment.CHUNK_LINKS, 300):
        monkeypatch.setattr(token_alignment, "CHUNK_LINKS", size)
        got = token_alignment.align_corpus(df, *map(tokenizer_model, FILES))
        assert got.columns == columns
        assert sorted(map(tuple, got.collect()), key=repr) == expected
    assert token_alignment.align_corpus(df.limit(0), *map(tokenizer_model, FILES)).count() == 0
    one = token_alignment.alignments(df.where("doc_id = 3"), *map(tokenizer_model, FILES)).first()
    assert hashlib.sha256(";".join(f"{','.join(map(str, g['a']))}|{','.join(map(str, g['b']))}" for g in one["groups"]).encode()).hexdigest() == next(e[-1] for e in expected if e[0] == 3)


def test_diagonal_runs_are_skipped():
    """Random ends against a plain walk, and few comparisons in a long one-to-one stretch."""
    rng = random.Random(5)
    for _ in range(300):
        common = sorted(rng.sample(range(1, 400), rng.randint(1, 60)))
        sides = [np.array(sorted({*common, *rng.sample(range(1, common[-1] + 1), min(common[-1], rng.choice([0, 2, 30])))})) for _ in range(2)]
        moves = token_alignment.align(*sides)
        i, j = token_alignment.links(moves)
        starts = [np.concatenate([[0], s[:-1]]) for s in sides]
        assert list(zip(i, j, strict=True)) == [(x, y) for x in range(len(sides[0])) for y in range(len(sides[1])) if starts[0][x] < sides[1][y] and starts[1][y] < sides[0][x]]
        assert (moves == 3).sum() == len(set(sides[0]) & set(sides[1]))
    ends = np.arange(1, 100_001)
    assert len(token_alignment.align(ends, ends)) == 100_000


def test_byte_alphabet_is_a_bijection():
    assert sorted(token_alignment.byte_alphabet().values()) == list(range(256))
