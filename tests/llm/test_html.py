from __future__ import annotations

import itertools
import random
import time

import numpy as np
import pytest

from eraloom.llm import html_extract
from eraloom.llm.html_blocks import Block, blocks


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks_of_broken_markup():
    page = """<!DOCTYPE html><html><head><title>no &amp; no</title><style>p{}</style><script>var t="</p><p>no";</script></head>
    <body><ul><li><a href="x">one</a><li>two</ul><!-- <p>no</p> --><p><b>bold &lt;i&gt;<br>next<p>a&nbsp;&#8212;
      b&eacute; <i>c</i>d</i></p></div>1 < 2 &copy 3<table><tr><td>x<td>y<tr><td>z</table><pre> k
      l</pre><p title="a>b">quoted</p><p class='un>tail <script>no"""
    assert texts(page) == ["one", "two", "bold <i> next", "a — bé cd", "1 < 2 © 3", "x", "y", "z", "k l", "quoted", "tail"]
    assert texts(None) == texts("") == texts(" \n<p></p>") == [] and texts("plain") == ["plain"]
    assert texts("<div>a</div") == ["a"] and texts("a<!-- b") == ["a"] and texts("x<3 y</p>z") == ["x<3 y", "z"]


@pytest.mark.parametrize("page", ["<div>" * 60_000 + "x", "<p>x" * 60_000, "<a ='" * 40_000, "<" * 100_000, "<div " + "a" * 300_000 + ">", "<p><b>" * 30_000, "<!--" * 50_000, '<p a="' * 50_000, "<script>" * 30_000])
def test_long_broken_pages_stay_linear(page):
    began = time.process_time()
    blocks(page)
    assert time.process_time() - began < 20


def every_labeling(emissions, contexts, moves):
    for labels in itertools.product((0, 1), repeat=len(emissions)):
        yield labels, sum(e for e, y in zip(emissions, labels, strict=True) if y) + sum(moves[c][a][b] for c, (a, b) in zip(contexts[1:], itertools.pairwise(labels), strict=True))


def test_sums_and_gradient_over_all_labelings():
    rng = np.random.default_rng(2)
    lengths = np.array([1, 4, 6])
    emissions, contexts = rng.normal(size=(3, 6)), rng.integers(0, html_extract.CONTEXTS, (3, 6))
    moves = rng.normal(size=(html_extract.CONTEXTS, 2, 2))
    total, chance, pairs = html_extract.log_likelihood(emissions, contexts, lengths, moves)
    expected = np.zeros_like(pairs)
    for i, n in enumerate(lengths):
        every = list(every_labeling(emissions[i, :n], contexts[i, :n], moves))
        whole = sum(np.exp(s) for _, s in every)
        assert np.isclose(total[i], np.log(whole))
        assert np.allclose(chance[i, :n], [sum(np.exp(s) for y, s in every if y[t]) / whole for t in range(n)])
        for labels, s in every:
            for t in range(1, n):
                expected[contexts[i, t], labels[t - 1], labels[t]] += np.exp(s) / whole
    assert np.allclose(pairs, expected)


def test_viterbi_against_all_labelings():
    rng = np.random.default_rng(3)
    for _ in range(100):
        page = [Block("x", [f"f{k}"], int(rng.integers(0, 3)), int(rng.integers(0, 3))) for k in range(int(rng.integers(1, 8)))]
        weights = {f"f{k}": float(v) for k, v in enumerate(rng.normal(size=8))}
        moves = rng.normal(size=(html_extract.CONTEXTS, 2, 2))
        contexts = [0, *(html_extract.context(a, b) for a, b in itertools.pairwise(page))]
        best = max(every_labeling([weights[f"f{k}"] for k in range(len(page))], contexts, moves), key=lambda x: x[1])[0]
        assert html_extract.Field(weights, moves).label(page) == list(best)
    assert html_extract.Field({}, np.zeros((3, 2, 2))).label([]) == []


def test_held_out_labelled_pages():
    """Blocks of pages that were not learned; labels that rest on a name unseen in training stay open."""
    wrong = total = whole = 0
    pages = html_extract.labelled_pages(200, seed=77)
    for page in pages:
        missed = sum(a != b.marked for a, b in zip(html_extract.trained().label(page), page, strict=True))
        wrong, total, whole = wrong + missed, total + len(page), whole + (missed == 0)
    assert wrong / total < 0.015 and whole / len(pages) > 0.85


PROSE = ["The council met on Tuesday to discuss the new bridge, which has been delayed twice.", "Nobody expected it.", "Engineers said that the river bed, long thought stable, had shifted by a metre since the survey."]
SITES = [
    '<header><h1><a href="/">Daily</a></h1><nav><a href="/a">World</a> <a href="/b">Sport</a></nav></header><div role="alert">We use cookies. <button>OK</button></div><main><article><h1>Bridge late</h1>{p}<aside class="ad">Buy shoes now!</aside></article></main><aside><h3>Related</h3><ul><li><a href="/c">Other bridges of note</a></ul></aside><footer>&copy; Daily</footer>',
    '<div id="menu"><ul><li><a href="/">Home</a></li><li><a href="/x">About us</a></li></ul></div><div class="content"><h1>Bridge late</h1>{p}</div><div class="sidebar"><p>Most read this week, chosen by our editors.</p></div><div id="footer">Copyright 2020 Daily. All rights reserved.</div>',
    '<nav><ul><li><a href="/a">a</a></li><li><a href="/b">b</a></li></ul></nav><div class="ad">Nice adverts here. Really.</div><article><h1>Bridge late</h1><p><b>{q}<br>{p}</article><section class="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>What a waste of money, as always.</p></div></section><form class="newsletter"><p>Get our newsletter every day.</p><label>Mail</label><input></form><footer>&copy; x &middot; Some words here.</footer>',
]


@pytest.mark.parametrize("site", SITES)
def test_hand_made_pages(site):
    page = "<html><body>" + site.format(p="".join(f"<p>{t}</p>" for t in PROSE), q="First line.") + "</body></html>"
    want = ["Bridge late", *(["First line."] if "{q}" in site else []), *PROSE]
    assert html_extract.main_text(page, html_extract.trained()).split("\n") == want


def test_extraction(spark):
    rng = random.Random(1)
    prose = [" ".join(rng.choice(["stone", "river", "of", "and", "late,"]) for _ in range(30)) + "." for _ in range(3)]
    page = "<nav><ul><li><a href='/'>x</a></ul></nav><article><h1>Title</h1>" + "".join(f"<p>{t}</p>" for t in prose) + "</article><footer>&copy; y</footer>"
    long = "<article>" + "".join(f"<p>{t}</p>" for t in prose * 3000) + "</article>"
    want, all_long = "\n".join(["Title", *prose]), "\n".join(prose * 3000)
    rows = [(1, "u", page, want), (2**62 + 1, None, page, want), (2**53 + 1, "u", None, ""), (None, "v", "", ""), (None, None, page, want), (4, "w", "<nav><ul><li><a href=x>only</a></ul></nav>", ""), (5, "l", long, all_long), (1, "u", page, want)]
    df = spark.createDataFrame([(*r[:3], "clash") for r in rows], "page_id long, url string, html string, text string").repartition(3)
    got = html_extract.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, u, t, len(t)) for i, u, _, t in rows), key=repr)
    assert html_extract.extract(df.limit(0)).count() == 0
