"""Main text of web pages: flat text blocks, judged by a decision tree.

A page becomes a flat list of text blocks. Each has its word count and link
density, those of its neighbours, and the zone its innermost marked container
says (article, page furniture, or none). A small decision tree, grown here by
the Gini rule on the labelled blocks below, says which blocks are main text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from demandloom.llm.common import map_batches, texts_of

# Element names of HTML and the usual names of page parts.
#: Text up to their end tag or the end of the page.
RAW = "script style textarea".split()
#: Hidden up to their end tag; without one, or closed in the tag itself, only the tag is. A head holds nothing but these,
#: RAW and VOID elements: what else stands in it begins the body.
HIDDEN = set("title noscript template svg math iframe object canvas audio video select".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var wbr img".split())
ARTICLE = {"article", "main"}
FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
ARTICLE_NAMES = set("article articlebody main post content entry story".split())
FURNITURE_NAMES = set(
    "ad ads advert advertisement banner sponsored promo nav navbar navigation menu header footer sidebar aside widget "
    "breadcrumb breadcrumbs pagination pager comment comments reply replies disqus cookie cookies consent notice notices "
    "alert popup modal newsletter subscribe signup login share social related recommended toolbar search form copyright "
    "complementary contentinfo".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<hidden>" + "|".join(RAW) + r")(?=[\s>/])(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</(?P=hidden)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?/][^>]*>", re.S | re.I)
END = {name: re.compile(rf"</{name}\s*>", re.I) for name in HIDDEN}
NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# What hides an element: the attribute hidden, aria-hidden="true", or a style with display:none; never a part of a name or value.
QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
HIDDEN_ATTRIBUTE = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)
HIDDEN_VALUE = re.compile(r"(?:^|\s)aria-hidden\s*=\s*[\"']?true\b|(?:^|\s)style\s*=\s*(?:\"[^\"]*|'[^']*|[^\s\"']*)display\s*:\s*none", re.I)
#: A class that says what a wrapper has, not what it is: has-sidebar, no-footer.
ABOUT = {"has", "with", "no", "without"}
#: A furniture container that holds a page's title or article and more than this share of its words is the page's wrapper.
WRAPPER = 0.5
HEADER = re.compile(r"\bclass\s*=\s*[\"']?[^\"'>]*\b(?:post|entry|article)-header\b", re.I)
SPACE = re.compile(r"\s+")

NONE, MAIN, ASIDE, HIDES = 0, 1, 2, 3


@dataclass
class Block:
    text: str
    words: int
    linked: int
    zone: int
    heading: bool
    label: str | None = None
    #: What the containers around it say, from the outermost: zone, container, is it a header.
    marks: tuple[tuple[int, int, bool], ...] = ()

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _zone(name: str, attributes: str) -> int | None:
    """What the element says about its content; None: nothing."""
    if name in FURNITURE:
        return ASIDE
    if attributes:
        if HIDDEN_ATTRIBUTE.search(QUOTED.sub('""', attributes)) or HIDDEN_VALUE.search(attributes):
            return HIDES
        found = set()
        for m in NAMES.finditer(attributes):
            for one in (m[1] or m[2] or m[3] or "").lower().split():
                parts = re.split(r"[_-]+", one)
                found.update(parts if parts[0] not in ABOUT else ())
        if found & FURNITURE_NAMES and name not in ARTICLE and name not in ("body", "html"):
            return ASIDE
        if name in ARTICLE or (found & ARTICLE_NAMES and name not in ("body", "html")):
            return MAIN
    return MAIN if name in ARTICLE else None


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in page order. Unclosed and misplaced tags are tolerated."""
    out: list[Block] = []
    parts: list[tuple[str, bool]] = []
    stack: list[tuple[str, tuple, bool, str | None]] = []  # name, marks, heading, label
    marks, links, heading, label = (), 0, False, None
    containers = 0
    titled: set[int] = set()  # containers with an h1, an article or a main element

    def flush() -> None:
        nonlocal parts
        if parts:
            text = SPACE.sub(" ", unescape("".join(p for p, _ in parts))).strip()
            if text:
                linked = sum(len(unescape(p).split()) for p, link in parts if link)
                words = text.count(" ") + 1
                out.append(Block(text, words, min(linked, words), NONE, heading, label, marks))
            parts = []

    at = 0
    open_ended: set[str] = set()  # names without an end tag in the rest of the page
    last = page.rfind(">")  # behind it no tag ends: searching there would take the square of its length
    while at <= last and (m := TOKEN.search(page, at)):
        if m.start() > at:
            parts.append((page[at:m.start()], links > 0))
        at = m.end()
        name = m["name"]
        if name is None:
            if m["hidden"]:
                flush()
            continue
        name = name.lower()
        if name == "head":
            flush()
            continue
        if name in HIDDEN:
            flush()
            if not m["end"] and not m["attributes"].endswith("/") and name not in open_ended:
                if end := END[name].search(page, at):
                    at = end.end()
                else:
                    open_ended.add(name)
            continue
        if m["end"]:
            if name not in INLINE:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if name in INLINE and stack[k][0] not in INLINE:
                    break  # an inline end tag does not close blocks
        elif name in VOID:
            if name == "br":
                parts.append((" ", False))
            elif name not in INLINE:
                flush()
            continue
        else:
            if name not in INLINE:
                flush()
                if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):  # these end their open siblings
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] == name:
                            del stack[k:]
                            break
                        if stack[k][0] in ("ul", "ol", "table", "dl", "div", "article", "section", "main", "aside",
                                           "body", "blockquote", "nav", "header", "footer", "form"):
                            break
            if m["attributes"].rstrip().endswith("/"):
                continue
            told = _zone(name, m["attributes"])
            mark = re.search(r'data-label="(\w+)"', m["attributes"]) if "data-label" in m["attributes"] else None
            around = stack[-1][1] if stack else ()
            if name in ("h1", "article", "main"):
                titled.update(c for _, c, _ in around)
            if told is not None:
                containers += 1
                around = (*around, (told, containers, name == "header" or bool(HEADER.search(m["attributes"]))))
            stack.append((name, around,
                          (bool(stack) and stack[-1][2]) or bool(re.fullmatch("h[1-6]", name)),
                          mark[1] if mark else (stack[-1][3] if stack else None)))
        if name not in INLINE:
            marks, heading, label = stack[-1][1:] if stack else ((), False, None)
        links = sum(1 for s in stack if s[0] == "a")
    if at < len(page):
        parts.append((page[at:].partition("<!--")[0], links > 0))
    flush()
    _place(out, titled)
    return out


def _place(found: list[Block], titled: set[int]) -> None:
    """Each block's zone: what its innermost container says, wrappers of the page aside.

    A heading in the header of an article belongs to the article.
    """
    words: dict[int, int] = {}
    for b in found:
        for _, container, _ in b.marks:
            words[container] = words.get(container, 0) + b.words
    total = sum(b.words for b in found)
    wrappers = {c for c in titled if words.get(c, 0) > WRAPPER * total}
    for b in found:
        own = [m for m in b.marks if m[0] != ASIDE or m[1] not in wrappers]
        if any(z == HIDES for z, _, _ in own):
            b.zone = ASIDE
        elif own:
            b.zone = own[-1][0]
            if b.zone == ASIDE and b.heading and own[-1][2] and len(own) > 1 and own[-2][0] == MAIN:
                b.zone = MAIN


def features(found: list[Block]) -> np.ndarray:
    """A row per block: words, density, both of the neighbours, zone, heading."""
    own = np.array([[b.words, b.density] for b in found], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    before, after = np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])
    marks = np.array([[b.zone == MAIN, b.zone == ASIDE, b.heading] for b in found], float).reshape(-1, 3)
    return np.hstack([own, before[: len(own)], after[: len(own)], marks])


# The labelled table: small pages in which every block carries its label, main or other.
_LONG = ("The river rose through the night and by morning the lower fields were under water, so the farmers moved their "
         "animals to the hill and waited there for the rain to stop.")
_MIDDLE = "Nobody in the village could remember such a flood, not even the oldest of them."
LABELLED = [
    # marked containers
    f'<body><nav data-label="other"><ul><li><a>Home</a><li><a>News of the day</a></ul></nav><div class="ad" data-label="other">'
    f'{_MIDDLE}</div><article data-label="main"><h1>The flood</h1><p>{_LONG}<p>{_MIDDLE}<p>So it was.<p>{_LONG}</article>'
    f'<footer data-label="other">&copy; the paper, all rights reserved</footer>',
    f'<header data-label="other"><h2>The Paper</h2><p>{_MIDDLE}</p></header><main data-label="main"><h2>Rain</h2><p>Why?</p>'
    f'<p>{_LONG} {_LONG}</p><ul><li><a>The first report</a> on it</li><li>A second one</li></ul></main>'
    f'<aside data-label="other"><p>{_LONG}</p><p><a>More of this</a></p></aside>',
    f'<div class="cookie-notice" data-label="other"><p>{_LONG}</p></div><article data-label="main"><p>{_MIDDLE}</p>'
    f'<p><a>See the map of all the fields</a></p><p>{_LONG}</p></article><section id="comments" data-label="other">'
    f'<p>{_LONG}</p><p>I agree.</p><form><p>Your name</p></form></section>',
    f'<form data-label="other"><p>Search</p><p>{_MIDDLE}</p></form><article data-label="main"><p>Short.</p></article>'
    f'<div id="sidebar" data-label="other"><h3>Related</h3><p>{_LONG}</p><ul><li><a>One</a></li><li><a>Two</a></li></ul></div>',
    # nothing marked: words and links decide
    f'<div data-label="other"><a>Home</a> <a>About us</a> <a>Contact</a></div><div data-label="main"><h1>Rain</h1><p>{_LONG}</p>'
    f'<p>{_MIDDLE}</p><p>{_LONG} {_MIDDLE}</p></div><div data-label="other"><a>Terms of use</a> <a>Privacy</a></div>',
    f'<table><tr><td data-label="other"><a>Start</a></td><td data-label="other"><a>Next page</a></td></tr></table>'
    f'<p data-label="main">{_LONG}</p><p data-label="main">{_MIDDLE} <a>See here</a> {_LONG}</p><p data-label="main">{_LONG}</p>'
    f'<p data-label="other"><a>{_MIDDLE}</a></p><p data-label="other"><a>Read more</a></p><p data-label="other">Page 2</p>',
    f'<p data-label="main">{_LONG} {_LONG}</p>',
    f'<p data-label="main">{_MIDDLE}</p><p data-label="main">{_LONG}</p>',
    '<div data-label="other"><a>One</a></div><div data-label="other"><a>Two of them</a></div><div data-label="other">Top</div>',
]
# Marked containers hold text of any length and any number of links: every pair of these blocks, in both kinds of container.
_BLOCKS = ["<p>Two</p>", f"<p>{_MIDDLE}</p>", f"<p>{_LONG} {_LONG}</p>", "<p><a>See all</a></p>",
           f"<p>So <a>{_MIDDLE}</a></p>", "<h2>Rain</h2>"]
LABELLED += [f'<div>{before}</div><{name} data-label="{label}">{one}{two}</{name}>{after}'
             for one in _BLOCKS for two in _BLOCKS
             for name, label, before, after in (
                 ("article", "main", "", ""),
                 ("aside", "other", f'<p data-label="main">{_LONG}</p>', f'<p data-label="main">{_LONG}</p>'))]


@dataclass
class Node:
    answer: bool
    feature: int = -1
    cut: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1) -> Node:
    """A classification tree by the largest fall of the Gini impurity; ties go to the first feature and cut."""
    node = Node(bool(y.mean() >= 0.5))
    if depth == 0 or y.min() == y.max():
        return node

    def impurity(part: np.ndarray) -> float:
        return len(part) * part.mean() * (1 - part.mean())

    best = impurity(y) - 1e-9
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            if min(low.sum(), (~low).sum()) >= least and (now := impurity(y[low]) + impurity(y[~low])) < best:
                best, node.feature, node.cut = now, f, float(cut)
    if node.feature >= 0:
        low = x[:, node.feature] <= node.cut
        node.low, node.high = grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)
    return node


def judge(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.answer)
    low = x[:, node.feature] <= node.cut
    out = np.empty(len(x), bool)
    out[low], out[~low] = judge(node.low, x[low]), judge(node.high, x[~low])
    return out


@cache
def tree() -> Node:
    rows, labels = [], []
    for page in LABELLED:
        found = blocks(page)
        rows.append(features(found))
        labels += [b.label == "main" for b in found]
    return grow(np.vstack(rows), np.array(labels))


def main_text(page: str) -> str:
    """The main text of a page: its main blocks in page order, joined by one space."""
    found = blocks(page)
    if not found:
        return ""
    return " ".join(b.text for b, main in zip(found, judge(tree(), features(found))) if main)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Null html is an empty page; a page without main text has the empty text.
    Pages are independent rows: nothing is shuffled, repeated pages stay, extra
    columns are dropped.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page) for page in texts_of(batch, "html")]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return map_batches(pages.select("page_id", "url", "html"), run,
                       f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
