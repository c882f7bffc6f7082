"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is read as the sequence of its leaf blocks (``html_blocks``). Each block is main
text or not; features of its ancestors (tags, class and id words, the sections around it) and
of its own text (length, links, punctuation, kind of block) speak for one of the two,
and a change between neighbours is weighed by how they hang together: in one element, in one
grandparent, or apart. Weights maximise the likelihood of labelled pages with a
square penalty (forward-backward sums give the gradient, in steps of Adam); Viterbi
decoding takes a page's likeliest labels as a whole.

No table holds labelled pages, so they are made by rule: ``labelled_pages`` draws ``TRAINING`` pages
from a grammar of page parts (menus, headers, notices, adverts, articles with
headings, lists, quotes and broken markup, comments, sidebars, forms, footers) in many
orders and namings, with words of random syllables, so that nothing is learned from a
language; elements of the article bear an attribute that only training reads. A third of these
pages has no names at all, so that tags, links and text must decide. The model is
fitted once on the driver, some hundred weights, and is sent to the tasks. Pages
are judged one by one in one pass without a shuffle; a page's cost is linear in its length.

Defined cases: a null or empty html, one without text or one without main text gives an empty text;
page_id and url are returned as they are, null, repeated or not; unclosed, stray and cut-off tags are
repaired; an empty table gives no rows. Extra columns are ignored. A line break
inside a block is white space.
"""

from __future__ import annotations

import functools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eraloom.llm.html_blocks import Block, blocks

#: Labelled pages that are drawn, steps of fitting, and the penalty of squared weights.
TRAINING, STEPS, PENALTY = 700, 120, 0.1
CONTEXTS = 3

#: Names that authors give to parts of pages.
NAMES = {
    "nav": "nav menu navbar navigation main-menu top-nav breadcrumb breadcrumbs site-nav nav-menu topbar toc skip-links".split(),
    "header": "header masthead site-header page-header banner top logo branding".split(),
    "notice": "notice cookie-notice cookie cookie-banner consent gdpr alert announcement message popup modal overlay privacy-notice paywall warning".split(),
    "ad": "ad ads advert advertisement ad-box ad-slot adsense sponsored sponsor promo promotion banner-ad dfp teaser".split(),
    "sidebar": "sidebar side aside widget widget-area related related-posts recommended trending popular more-links rail secondary recent-posts archive tag-cloud".split(),
    "form": "form newsletter subscribe subscription signup sign-up search search-form login contact-form".split(),
    "footer": "footer site-footer page-footer bottom copyright legal colophon credits".split(),
    "comments": "comments comment-list comments-area replies responses discussion reader-comments disqus respond reviews".split(),
    "comment": "comment reply comment-body response review".split(),
    "share": "share social share-buttons social-links sharing follow tags tag-list pagination pager byline meta author-box post-meta".split(),
    "main": "content article post entry story main article-body post-content entry-content story-body article-content text body-text main-content page-content post-body single-post".split(),
}
ROLES = {"nav": "navigation", "header": "banner", "notice": "alert", "sidebar": "complementary", "form": "search", "footer": "contentinfo", "main": "main"}


class Grammar:
    """Random pages whose article is known."""

    def __init__(self, rng: random.Random):
        self.rng, self.named = rng, True
        sounds = ["".join(rng.sample("bdfgklmnprstvz", 1) + rng.sample("aeiou", 1) + rng.choices(["", "n", "r", "s"], [4, 1, 1, 1])) for _ in range(60)]
        self.words = ["".join(rng.choices(sounds, k=rng.choice([1, 1, 2, 2, 3]))) for _ in range(400)]

    def phrase(self, low: int, high: int) -> str:
        return " ".join(self.rng.choice(self.words) for _ in range(self.rng.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        out = []
        for _ in range(self.rng.randint(low, high)):
            words = self.phrase(3, 18).split()
            if len(words) > 6 and self.rng.random() < 0.6:
                words[self.rng.randrange(2, 5)] += ","
            out.append(" ".join(words).capitalize() + self.rng.choice([".", ".", ".", ".", "!", "?"]))
        return " ".join(out)

    def link(self, low: int = 1, high: int = 4) -> str:
        return f'<a href="/{self.rng.choice(self.words)}">{self.phrase(low, high)}</a>'

    def tagged(self, tag: str, role: str, inside: str, main: bool = False) -> str:
        """An element, named after its role if this page names its parts."""
        attributes = " data-main=1" if main else ""
        if self.named and self.rng.random() < 0.85:
            name = self.rng.choice(NAMES[role])
            attributes += f' {self.rng.choice(["class", "class", "id"])}="{name if self.rng.random() < 0.7 else name + " " + self.rng.choice(self.words)}"'
        if self.named and role in ROLES and self.rng.random() < 0.15:
            attributes += f' role="{ROLES[role]}"'
        return f"<{tag}{attributes}>{inside}</{tag}>"

    def pick(self, *tags: str) -> str:
        """The telling tag more often where names do not help."""
        return tags[0] if self.rng.random() < (0.5 if self.named else 0.8) else self.rng.choice(tags)

    def nav(self) -> str:
        links = [self.link(1, 3) for _ in range(self.rng.randint(3, 10))]
        inside = self.rng.choice(["<ul>{}</ul>".format("".join(f"<li>{x}</li>" for x in links)), " | ".join(links), "<ul><li>" + "<li>".join(links) + "</ul>"])
        return self.tagged(self.pick("nav", "div"), "nav", inside)

    def header(self) -> str:
        inside = self.rng.choice([f"<h1>{self.link(1, 2)}</h1>", f"<p>{self.phrase(1, 3)}</p>", f"<div>{self.link(1, 2)}</div>"])
        inside += self.rng.choice(["", f"<p>{self.phrase(3, 8)}</p>", self.nav(), self.form()])
        return self.tagged(self.pick("header", "div"), "header", inside)

    def notice(self) -> str:
        text = self.sentences(1, 2)
        return self.tagged(self.pick("aside", "div", "section"), "notice", self.rng.choice([text, f"<p>{text}</p>", f"<p>{text} {self.link()}</p>"]) + self.rng.choice(["", f"<button>{self.phrase(1, 2)}</button>"]))

    def ad(self) -> str:
        text = self.rng.choice([self.sentences(1, 3), self.link(2, 6), self.sentences(1, 2) + " " + self.link(1, 3)])
        return self.tagged(self.pick("aside", "div", "div"), "ad", self.rng.choice([text, f"<p>{text}</p>"]))

    def sidebar(self) -> str:
        links = "".join(f"<li>{self.link(2, 8)}</li>" for _ in range(self.rng.randint(2, 6)))
        inside = f"<{self.rng.choice(['h2', 'h3', 'h4', 'p'])}>{self.phrase(1, 3)}</{self.rng.choice(['h2', 'h3', 'h4', 'p'])}>"
        inside += self.rng.choice([f"<ul>{links}</ul>", f"<p>{self.sentences(1, 3)}</p>", f"<ul>{links}</ul><p>{self.sentences(1, 2)}</p>"])
        return self.tagged(self.pick("aside", "div"), "sidebar", inside)

    def form(self) -> str:
        fields = f"<label>{self.phrase(1, 3)}</label><input name=q><button>{self.phrase(1, 2)}</button>"
        inside = self.rng.choice(["", f"<p>{self.sentences(1, 1)}</p>", f"<h3>{self.phrase(2, 5)}</h3>"]) + fields
        return self.tagged("form", "form", inside) if self.rng.random() < 0.7 else self.tagged("div", "form", f"<form>{inside}</form>")

    def footer(self) -> str:
        inside = self.rng.choice(["&copy; ", "© ", "", "&copy; 2019 "]) + self.phrase(1, 3) + self.rng.choice(["", " &middot; " + self.sentences(1, 3), " | ".join(["", self.link(), self.link()])])
        inside = self.rng.choice([inside, f"<p>{inside}</p>", f"<ul><li>{self.link()}<li>{self.link()}</ul><p>{inside}</p>"])
        return self.tagged(self.pick("footer", "div"), "footer", inside)

    def comments(self) -> str:
        out = [f"<h3>{self.rng.randint(1, 90)} {self.phrase(1, 2)}</h3>"] if self.rng.random() < 0.7 else []
        tag = self.rng.choice(["div", "li", "article", "p"])
        for _ in range(self.rng.randint(1, 5)):
            by = self.rng.choice([f"<b>{self.phrase(1, 2)}</b> ", f"<div>{self.link(1, 2)}</div>" if tag != "p" else "", f"<cite>{self.phrase(1, 2)}</cite> "])
            out.append(self.tagged(tag, "comment", by + (self.sentences(1, 4) if tag == "p" or self.rng.random() < 0.4 else f"<p>{self.sentences(1, 4)}</p>")))
        inside = "".join(out)
        if tag == "li":
            inside = f"<ol>{inside}</ol>"
        was, self.named = self.named, True  # without a name nothing tells comments from an article
        inside = self.tagged(self.rng.choice(["section", "div", "div", "aside"]), "comments", inside + self.rng.choice(["", self.form()]))
        self.named = was
        return inside

    def share(self) -> str:
        return self.tagged(self.rng.choice(["div", "p", "ul"]), "share", self.rng.choice([" ".join(self.link(1, 1) for _ in range(3)), self.phrase(2, 4)]))

    def part(self) -> str:
        """One element of an article."""
        kind = self.rng.random()
        text = self.sentences(1, 7)
        if kind < 0.62:
            if self.rng.random() < 0.2:
                text = text.replace(" ", f" {self.link()} ", 1)
            return f"<p data-main=1>{self.rng.choice(['', '', '', '<b>', '<i>x</i> '])}{text}{self.rng.choice(['</p>', '</p>', '</p>', '', '<br>'])}"
        if kind < 0.7:
            return f"<p data-main=1>{self.rng.choice([self.phrase(1, 6).capitalize() + '.', self.phrase(1, 5)])}</p>"
        if kind < 0.78:
            tag = self.rng.choice(["h2", "h2", "h3", "h4"])
            return f"<{tag} data-main=1>{self.phrase(1, 7)}</{tag}>"
        if kind < 0.85:
            tag = self.rng.choice(["ul", "ol"])
            return f"<{tag} data-main=1>" + "".join(f"<li>{self.rng.choice([self.sentences(1, 2), self.phrase(1, 6)])}</li>" for _ in range(self.rng.randint(2, 5))) + f"</{tag}>"
        if kind < 0.9:
            return f"<blockquote data-main=1>{self.rng.choice([text, f'<p>{text}</p>'])}</blockquote>"
        if kind < 0.93:
            return f"<pre data-main=1>{self.phrase(3, 20)}\n{self.phrase(2, 9)}</pre>"
        if kind < 0.96:
            return f"<figure data-main=1><img src=x><figcaption>{self.phrase(3, 12)}</figcaption></figure>"
        return "<table data-main=1>" + "".join(f"<tr><td>{self.phrase(1, 3)}<td>{self.phrase(1, 4)}" for _ in range(self.rng.randint(2, 4))) + "</table>"

    def article(self) -> str:
        title = f"<h1 data-main=1>{self.rng.choice([self.phrase(2, 10), self.sentences(1, 1)])}</h1>"
        if self.rng.random() < 0.15:
            title = f"<header>{title}</header>"
        parts = [self.part() for _ in range(self.rng.choice([1, 2, 3, 5, 8, 12, 18]))]
        for make, rate in ((self.ad, 0.12), (self.share, 0.12), (self.form, 0.06), (self.sidebar, 0.08)):
            if self.rng.random() < rate:
                parts.insert(self.rng.randint(0, len(parts)), make())
        if self.rng.random() < 0.06:
            parts = ["".join(f"<div data-main=1>{self.sentences(1, 5)}</div>" for _ in parts)]
        if self.rng.random() < 0.15:
            parts.append(self.comments())
        inside = (title if self.rng.random() < 0.9 else "") + "".join(parts)
        shape = self.rng.random()
        if shape < 0.45:
            return self.tagged("article", "main", inside)
        if shape < 0.6:
            return self.tagged("main", "main", inside)
        if shape < 0.7:
            return f"<main>{self.tagged('article', 'main', inside)}</main>"
        if shape < 0.78:
            return self.tagged("section", "main", inside)
        return self.tagged("div", "main", f"<div>{inside}</div>" if self.rng.random() < 0.3 else inside)

    def page(self) -> str:
        self.named = self.rng.random() < 0.67
        some = lambda make, rate: [make()] if self.rng.random() < rate else []
        head = [*some(self.header, 0.4), *some(self.nav, 0.75), *some(self.notice, 0.25), *some(self.ad, 0.35), *some(self.form, 0.15)]
        if self.rng.random() < 0.3:
            self.rng.shuffle(head)
        body = [*some(self.sidebar, 0.2), self.article(), *some(self.share, 0.15), *some(self.ad, 0.2), *some(self.comments, 0.3), *some(self.sidebar, 0.3), *some(self.form, 0.15), *some(self.notice, 0.1)]
        inside = "".join(body)
        if self.rng.random() < 0.3:
            inside = f'<div class="{self.rng.choice(["wrapper", "container", "page", "row", "grid"])}">{inside}</div>' if self.named else f"<div>{inside}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.phrase(2, 6)}</title></head><body>{''.join(head)}{inside}{''.join(some(self.footer, 0.9))}</body></html>"


def labelled_pages(n: int, seed: int = 1) -> list[list[Block]]:
    """Blocks of n pages; ``marked`` is their label."""
    out = []
    for k in range(n):
        out.append(blocks(Grammar(random.Random(f"{seed}:{k}")).page()))
    return [page for page in out if page]


def context(before: Block, block: Block) -> int:
    """How two neighbours hang together: in one element, in one grandparent, or apart."""
    return 0 if before.parent == block.parent or before.above == block.above and before.above else 1 if block.parent == before.above or block.above == before.parent else 2


class Field:
    """Weights of features for the label 1, and of label pairs by context."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray):
        self.weights, self.moves = weights, moves.tolist()

    def label(self, page: list[Block]) -> list[int]:
        """The likeliest labels of a page (Viterbi); equal scores are no main text."""
        no, yes = 0.0, 0.0
        back: list[tuple[int, int]] = []
        weight = self.weights.get
        for k, block in enumerate(page):
            emission = sum(weight(f, 0.0) for f in block.features)
            if k:
                (nn, ny), (yn, yy) = self.moves[context(page[k - 1], block)]
                back.append((int(yes + yn > no + nn), int(yes + yy > no + ny)))
                no, yes = max(no + nn, yes + yn), max(no + ny, yes + yy)
            yes += emission
        out = [int(yes > no)] if page else []
        for choice in reversed(back):
            out.append(choice[out[-1]])
        return out[::-1]


def log_likelihood(emissions: np.ndarray, contexts: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per page the log of the sum over all labelings; per block the chance of label 1; per context the
    expected label pairs. Pages are rows; ``emissions`` weigh label 1 (forward-backward)."""
    pages, longest = emissions.shape
    score = np.zeros((pages, longest, 2))
    score[:, :, 1] = emissions
    ahead, behind = np.zeros((pages, longest, 2)), np.zeros((pages, longest, 2))
    ahead[:, 0] = score[:, 0]
    for t in range(1, longest):
        step = ahead[:, t - 1, :, None] + moves[contexts[:, t]]
        ahead[:, t] = np.logaddexp(step[:, 0], step[:, 1]) + score[:, t]
    for t in range(longest - 2, -1, -1):
        step = moves[contexts[:, t + 1]] + (score[:, t + 1] + behind[:, t + 1])[:, None, :]
        inside = (t + 1 < lengths)[:, None]
        behind[:, t] = np.where(inside, np.logaddexp(step[:, :, 0], step[:, :, 1]), 0.0)
    last = ahead[np.arange(pages), lengths - 1]
    total = np.logaddexp(last[:, 0], last[:, 1])
    chance = np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None])
    joint = np.exp(ahead[:, :-1, :, None] + moves[contexts[:, 1:]] + (score + behind)[:, 1:, None, :] - total[:, None, None, None])
    joint[np.arange(1, longest)[None, :] >= lengths[:, None]] = 0
    place = 4 * contexts[:, 1:, None, None] + np.array([[0, 1], [2, 3]])
    pairs = np.bincount(place.reshape(-1), joint.reshape(-1), 4 * len(moves)).reshape(moves.shape)
    return total, chance, pairs


def fit(pages: list[list[Block]], steps: int = STEPS, penalty: float = PENALTY) -> Field:
    """Weights of greatest penalised likelihood on labelled pages; features of one page only are left out."""
    seen: dict[str, int] = {}
    for page in pages:
        for f in {f for b in page for f in b.features}:
            seen[f] = seen.get(f, 0) + 1
    known = {f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n > 1))}
    lengths = np.array([len(p) for p in pages])
    spots = np.array([(i, t) for i, p in enumerate(pages) for t in range(len(p))])
    active = [[known[f] for f in b.features if f in known] for p in pages for b in p]
    spot, feature = np.repeat(np.arange(len(active)), list(map(len, active))), np.array([k for row in active for k in row])
    gold = np.array([b.marked for p in pages for b in p], float)
    contexts = np.zeros((len(pages), lengths.max()), int)
    truth = np.zeros((CONTEXTS, 2, 2))
    for i, p in enumerate(pages):
        for t in range(1, len(p)):
            contexts[i, t] = context(p[t - 1], p[t])
            truth[contexts[i, t], int(p[t - 1].marked), int(p[t].marked)] += 1
    w, moves = np.zeros(len(known)), np.zeros((CONTEXTS, 2, 2))
    mean, square = np.zeros(w.size + moves.size), np.zeros(w.size + moves.size)
    emissions = np.zeros((len(pages), lengths.max()))
    for step in range(1, steps + 1):
        emissions[spots[:, 0], spots[:, 1]] = np.bincount(spot, w[feature], len(active))
        _, chance, pairs = log_likelihood(emissions, contexts, lengths, moves)
        missed = gold - chance[spots[:, 0], spots[:, 1]]
        slope = np.concatenate([np.bincount(feature, missed[spot], w.size) - penalty * w, ((truth - pairs) - penalty * moves).reshape(-1)])
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        move = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8) * (1 - step / (steps + 1)) ** 0.5
        w, moves = w + move[: w.size], moves + move[w.size :].reshape(moves.shape)
    return Field({f: float(w[k]) for f, k in known.items()}, moves)


@functools.lru_cache(maxsize=1)
def trained() -> Field:
    """The model of the labelled pages, fitted once a process."""
    return fit(labelled_pages(TRAINING))


def main_text(page: str | None, model: Field) -> str:
    """Main blocks in page order, one a line."""
    found = blocks(page)
    return "\n".join(b.text for b, label in zip(found, model.label(found), strict=True) if label)


def extract(pages: DataFrame, model: Field | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(model or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, sent.value) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kept = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return pages.select("page_id", "url", "html").mapInArrow(run, f"{kept}, text string, n_chars long")
