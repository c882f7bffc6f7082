"""HTML into leaf blocks: runs of text between block-level tags, with what is known of their place.

A tolerant scanner walks a page once: comments, declarations and raw elements (scripts,
styles, titles) are passed over, missing end tags are implied, stray ones ignored. Every step moves
forward, so broken markup costs no more than its length.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

#: Elements that break a line, that have no content, whose content is no markup, and that end others of their kind.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav noscript ol option optgroup p pre search section select summary table tbody td template tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
#: A paragraph ends at the next block unless one of these stands between.
SCOPES = frozenset("button caption html table td th template".split())
SECTIONS = frozenset("article aside footer form header main nav section".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>=]*+(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')?+[^>=]*+)*+)>")
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])([^\s=/>\"']++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+")
_NAMING = re.compile(r"class|id|role|itemprop|hidden|style|main", re.IGNORECASE)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE_END = (".", "!", "?", "…", "。", "！", "？", ":", ".”", '."', "»")


@dataclass
class Block:
    """A leaf block: its text, feature names, and the elements that hold it (parent and grandparent)."""

    text: str
    features: list[str]
    parent: int
    above: int
    marked: bool = False


@dataclass
class _Open:
    tag: str
    number: int
    features: list[str] = field(default_factory=list)
    block: bool = False
    marked: bool = False


def names(attributes: str) -> tuple[list[str], bool]:
    """Features of an element's class, id, role and visibility, and whether it carries the mark of labelled pages."""
    if not _NAMING.search(attributes):
        return [], False
    out, marked = [], False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id", "role", "itemprop"):
            out += [f"n:{t.lower()}" for t in dict.fromkeys(_TOKEN.findall(value))]
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", "").lower():
            out.append("hidden")
        elif key == "data-main":
            marked = True
    return out, marked


def text_features(text: str, linked: int, tag: str) -> list[str]:
    """Features of a block's own text; ``linked`` is its number of characters inside links."""
    words = text.count(" ") + 1
    size = 0 if words < 2 else 1 if words < 4 else 2 if words < 8 else 3 if words < 16 else 4 if words < 40 else 5
    share = linked / len(text)
    links = 0 if linked == 0 else 1 if share < 0.34 else 2 if share < 0.8 else 3
    ends = text.endswith(_SENTENCE_END)
    heading = len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
    kind = tag if heading or tag in ("p", "li", "td", "th", "dd", "pre", "button", "label") else "other"
    out = [f"words:{size}", f"links:{links}", f"tag:{kind}", f"tag:{kind} words:{size}", f"links:{links} words:{size}", f"ends:{ends} words:{size}"]
    if "©" in text[:80]:
        out.append("copyright")
    if "," in text:
        out.append("comma")
    return out


class _Page:
    def __init__(self):
        self.open: list[_Open] = [_Open("#page", 0)]
        self.tags: Counter[str] = Counter()
        self.active: Counter[str] = Counter()
        self.sections: list[str] = []
        self.made = 0
        self.marks = 0
        self.pieces: list[str] = []
        self.linked = 0
        self.blocks: list[Block] = []

    def flush(self) -> None:
        """The text gathered so far as a block."""
        if not self.pieces:
            return
        text = " ".join("".join(self.pieces).split())
        if text:
            holders = [e for e in self.open[-1:-40:-1] if e.block][:2] or self.open[:1]
            last = self.sections[-2:]
            close = next((e.features for e in reversed(self.open[-40:]) if any(f[0] == "n" for f in e.features)), ())
            features = [*self.active, *(f"near {f}" for f in close if f[0] == "n"), *text_features(text, min(self.linked, len(text)), holders[0].tag), f"in:{'>'.join(last)}"]
            self.blocks.append(Block(text, features, holders[0].number, holders[-1].number, self.marks > 0))
        self.pieces, self.linked = [], 0

    def push(self, tag: str, attributes: str) -> None:
        self.made += 1
        named, marked = ([], False) if tag in ("html", "body") else names(attributes)
        element = _Open(tag, self.made, [f"t:{tag}", *named] if tag in BLOCKS else named, tag in BLOCKS, marked)
        self.open.append(element)
        self.tags[tag] += 1
        self.active.update(element.features)
        self.marks += marked
        if tag in SECTIONS:
            self.sections.append(tag)

    def pop(self) -> None:
        element = self.open.pop()
        self.tags[element.tag] -= 1
        for f in element.features:
            self.active[f] -= 1
            if not self.active[f]:
                del self.active[f]
        self.marks -= element.marked
        if element.tag in SECTIONS:
            self.sections.pop()

    def close(self, wanted: set[str] | frozenset[str], stops: set[str] | frozenset[str]) -> None:
        """Close elements up to the outermost wanted one inside the nearest stop."""
        depth = None
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in wanted:
                depth = k
            elif self.open[k].tag in stops:
                break
        while depth is not None and len(self.open) > depth:
            self.pop()

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self.flush()
            if self.tags["p"]:
                self.close({"p"}, SCOPES)
            if tag in ENDS and any(self.tags[t] for t in ENDS[tag][0]):
                self.close(*ENDS[tag])
        elif tag in ("br", "img", "input"):
            self.pieces.append(" ")
        if tag not in VOID and (tag in BLOCKS or not attributes.endswith("/")):  # a slash does not close an element that has content
            self.push(tag, attributes)

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if not self.tags[tag]:
            return
        while self.open[-1].tag != tag:
            self.pop()
        self.pop()

    def text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        if self.tags["a"]:
            self.linked += len("".join(text.split()))
        self.pieces.append(text)


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order."""
    page, at, out = page or "", 0, _Page()
    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            out.text(page[at:])
            break
        if begin > at:
            out.text(page[at:begin])
        after = page[begin + 1 : begin + 2]
        if after == "!" or after == "?":
            stop = page.find("-->", begin + 2) if page.startswith("<!--", begin) else page.find(">", begin)
            at = len(page) if stop < 0 else stop + (3 if page.startswith("<!--", begin) else 1)
        elif found := _TAG.match(page, begin):
            tag, at = found[2].lower(), found.end()
            if found[1]:
                out.end(tag)
            elif tag in RAW:
                closing = re.compile(f"</{tag}(?=[\\s/>])[^>]*+>?", re.IGNORECASE).search(page, at)
                at = closing.end() if closing else len(page)
                out.pieces.append(" ")
            else:
                out.start(tag, found[3])
        elif after == "/" or after.isalpha():  # a tag that the page's end cuts off, or a bogus one
            stop = page.find(">", begin)
            at = len(page) if stop < 0 else stop + 1
        else:
            out.text("<")
            at = begin + 1
    out.flush()
    return out.blocks
