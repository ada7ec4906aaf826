"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of block elements with their runs of inline text. Every node
gets features of its subtree's density, its attribute tokens, its depth and its
siblings; gradient-boosted trees give the log odds that it holds main text. The
decoder chooses the set of nodes with the largest sum of log odds in which every
kept node's parent is kept, so no choice contradicts an ancestor's.

The trees are fitted once per process on labelled pages drawn from random layouts
(`training_pages`), since the tables hold no labels for pages.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE = 256
TRAINING_PAGES = 500
TREES, DEPTH, RATE, BINS = 40, 4, 0.3, 32

# --- fixed values: element kinds of HTML ------------------------------------

BLOCKS = frozenset(
    """address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol option p pre section select summary table tbody td
    tfoot th thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())  # text up to the end tag or the page's end
SKIPPED = frozenset("svg template annotation annotation-xml".split())  # not shown; left out only where they are closed
HTML_IN_SVG = frozenset("foreignobject desc title".split())
CLOSES_P = BLOCKS - {"body", "button", "dd", "dt", "li", "option", "select", "tbody", "td", "tfoot", "th", "thead", "tr"}
SELF_CLOSING = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th"),
}
LIMITS = frozenset("table ul ol dl select body td th".split())

# --- fixed values: words that page authors put into class, id and role -------

KINDS = {
    "bad": """aside banner bar bottom breadcrumb breadcrumbs button cookie cookies consent copyright crumbs dialog foot
    footer gdpr head header hidden links login masthead menu meta modal nav navbar navigation navi newsletter none notice
    outbrain pager pagination paging popup privacy promo promoted recommended related search share sharing side sidebar
    signup skip social sponsor subscribe subscription tags taboola toc toolbar tools top topbar warning widget widgets
    complementary contentinfo alert alertdialog""",
    "ad": "ad ads adv advert advertisement advertising adverts adsense adslot sponsor sponsored sponsors promo promotion",
    "comment": "comment comments commentary discuss discussion disqus reply replies respond responses reader feedback",
    "good": """article articlebody blog body content copy entry full hentry main maincontent page paragraph post postbody
    postcontent prose read story text""",
}
GROUPS = (
    ("h1", "h2", "h3", "h4", "h5", "h6"), ("p",), ("ul", "ol", "dl", "dir", "menu"), ("li", "dd", "dt"),
    ("div", "center", "body"), ("section",), ("article", "main"), ("nav",), ("header",), ("footer",),
    ("aside", "dialog", "details"), ("form", "fieldset", "button", "select", "option"),
    ("table", "tbody", "thead", "tfoot", "tr", "td", "th"), ("blockquote", "pre", "figure", "figcaption", "address", "summary"),
)
GROUP = {tag: k for k, tags in enumerate(GROUPS) for tag in tags}
LEXICON = {word: k for k, words in enumerate(KINDS.values()) for word in words.split()}
BAD_TAGS = frozenset("nav header footer aside dialog form fieldset button select menu".split())
GOOD_TAGS = frozenset("article main".split())

# Quotes enclose a value only right after its "="; elsewhere, and where none closes them, a tag ends at the first ">".
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>
    |<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=?+[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++)?+)?+|=)*+)>""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAMED = frozenset("class id role itemprop".split())
PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


# --- the tree ----------------------------------------------------------------


@dataclass
class Page:
    """Block nodes in page order; runs are (node, text, characters in links)."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    inline: list[int] = field(default_factory=list)  # inline tags right under the node
    runs: list[tuple[int, str, int]] = field(default_factory=list)

    def add(self, tag: str, parent: int, attributes: str = "") -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.attributes.append(attributes)
        self.inline.append(0)
        return len(self.tag) - 1


@lru_cache
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I)


def parse(source: str) -> Page:
    """The page's block tree; elements are closed as browsers do in the usual cases, unmatched end tags are ignored."""
    page = Page()
    stack = [page.add("body", -1)]
    opened: Counter = Counter({"body": 1})
    buffer: list[str] = []
    links = linked = svg = inner = 0
    math = False
    unclosed: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if buffer:
            if text := " ".join(entities.unescape("".join(buffer)).split()):
                page.runs.append((stack[-1], text, min(linked, len(text))))
            buffer.clear()
        linked = 0

    def pop_to(tags: tuple[str, ...], limits: frozenset[str]) -> None:
        """Close the nearest open element of these tags, unless a limit stands before it."""
        for k in range(len(stack) - 1, 0, -1):
            tag = page.tag[stack[k]]
            if tag in tags:
                flush()
                for node in stack[k:]:
                    opened[page.tag[node]] -= 1
                del stack[k:]
                return
            if tag in limits:
                return

    at, head = 0, False
    while True:
        found = TOKEN.search(source, at)
        text = source[at : found.start() if found else len(source)]
        if text and not head and not svg:
            buffer.append(text)
            if links:
                linked += len(text)
        if not found:
            break
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag, end = tag.lower(), found[1]
        empty = found[3].endswith("/")
        if svg:  # up to its end tag, or to a block that can't lie in it
            if tag == "svg" and not empty:
                svg += -1 if end else 1
            elif tag in HTML_IN_SVG and not empty:
                inner = max(0, inner + (-1 if end else 1))
            if tag not in BLOCKS or inner or (end and tag != "p"):
                continue
            svg = 0
        if tag == "head":
            head = not end
            continue
        if tag in RAW:
            if not end:
                close = _closing(tag).search(source, at)
                at = close.end() if close else len(source)
            continue
        if tag in SKIPPED:
            if not end and not empty and tag not in unclosed:
                close = _closing(tag).search(source, at)
                if not close:
                    unclosed.add(tag)
                elif tag == "svg":
                    svg, inner = 1, 0
                else:
                    at = close.end()
            continue
        if tag == "math":
            math = not end and not empty
            continue
        if tag == "noscript":
            continue
        if tag == "body":
            head = False
            if not end and not page.attributes[0]:
                page.attributes[0] = found[3]
            continue
        if tag == "html":
            continue
        if tag in BLOCKS:
            head = math = False
            if end:
                if opened[tag]:
                    pop_to((tag,), frozenset())
                else:
                    flush()
                continue
            flush()
            if tag in CLOSES_P and opened["p"]:
                pop_to(("p",), LIMITS)
            if tag in SELF_CLOSING:
                for _ in SELF_CLOSING[tag]:
                    if any(opened[t] for t in SELF_CLOSING[tag]):
                        pop_to(SELF_CLOSING[tag], LIMITS - set(SELF_CLOSING[tag]))
            if tag in VOID:
                continue
            stack.append(page.add(tag, stack[-1], found[3]))
            opened[tag] += 1
        else:
            if tag == "a":
                links = 0 if end else 1
            if not end and not math:
                page.inline[stack[-1]] += 1
            if tag in ("br", "img", "input", "wbr"):
                buffer.append(" " if tag == "br" else "")
    flush()
    return page


# --- features ----------------------------------------------------------------


def tokens(attributes: str) -> list[int]:
    """How many words of each kind stand in class, id, role and itemprop; hidden elements count as bad."""
    n = [0] * len(KINDS)
    if not attributes.strip(" /\n\t"):
        return n
    for m in ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name in NAMED:
            for word in PART.findall(value):
                if (k := LEXICON.get(word.lower())) is not None:
                    n[k] += 1
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "none" in value):
            n[0] += 1
    return n


N_FEATURES = 21 + len(GROUPS) + 2 * len(KINDS)
_tokens = lru_cache(4096)(lambda attributes: tuple(tokens(attributes)))


def features(page: Page) -> np.ndarray:
    """A row per node."""
    n = len(page.tag)
    parent = page.parent
    direct, subtree, linked, marks, words, inline = ([0] * n for _ in range(6))
    before, blocks = [0] * n, [1] * n
    total, k = 0, 0
    for node, text, links in page.runs:
        while k <= node:
            before[k] = total
            k += 1
        size = len(text)
        direct[node] += size
        subtree[node] += size
        linked[node] += links
        words[node] += text.count(" ") + 1
        marks[node] += text.count(".") + text.count(",") + text.count("?") + text.count("!")
        total += size
    for j in range(k, n):
        before[j] = total
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        subtree[p] += subtree[i]
        linked[p] += linked[i]
        words[p] += words[i]
        marks[p] += marks[i]
        blocks[p] += blocks[i]
        inline[i] += page.inline[i]
        inline[p] += inline[i]
        children[p].append(i)
    inline[0] += page.inline[0]
    depth, place, siblings, same, previous, following = ([0] * n for _ in range(6))
    for p, below in enumerate(children):
        below.reverse()
        tags = Counter(page.tag[i] for i in below)
        for at, i in enumerate(below):
            depth[i] = depth[p] + 1
            place[i], siblings[i], same[i] = at, len(below), tags[page.tag[i]]
            previous[i] = subtree[below[at - 1]] if at else 0
            following[i] = subtree[below[at + 1]] if at + 1 < len(below) else 0
    groups = np.zeros((n, len(GROUPS)))
    own = np.array([_tokens(a) if a else (0,) * len(KINDS) for a in page.attributes], float).reshape(n, -1)
    above = own.copy()
    bad, good = [0] * n, [0] * n
    for i, tag in enumerate(page.tag):
        groups[i, GROUP.get(tag, 4)] = 1
        p = parent[i]
        if p >= 0:
            above[i] += above[p]
            bad[i], good[i] = bad[p], good[p]
        bad[i] += tag in BAD_TAGS
        good[i] += tag in GOOD_TAGS
    a = lambda x: np.array(x, float)
    sub, wide = a(subtree), np.maximum(a(subtree), 1)
    link_share = a(linked) / wide
    up = np.maximum(a(parent), 0).astype(int)
    columns = [
        a(depth), a(place), (a(place) + 0.5) / np.maximum(a(siblings), 1), a(siblings), a(same),
        np.log1p(a(direct)), np.log1p(sub), sub / max(total, 1), link_share, link_share[up],
        100 * (a(blocks) + a(inline)) / wide, a(blocks), a(marks) / np.maximum(a(words), 1), np.log1p(a(words)),
        wide / np.maximum(a(words), 1), a(before) / max(total, 1), np.log1p(a(previous)), np.log1p(a(following)),
        a(bad), a(good), sub / np.maximum(sub[up], 1),
    ]
    return np.column_stack([*columns, groups, own, above])


# --- boosted trees -------------------------------------------------------------


@dataclass(frozen=True)
class Boosted:
    """Complete trees of DEPTH levels: feature and threshold of the inner nodes, values of the leaves."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        flat, width = np.ascontiguousarray(x).ravel(), x.shape[1]
        base = np.arange(len(x)) * width
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (flat[base + feature[at]] > threshold[at])
            out += leaf[at - len(feature)]
        return out


def boosted(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Boosted:
    """Newton boosting of the logistic loss on histograms of quantile bins."""
    n, m = x.shape
    inner = (1 << DEPTH) - 1
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) for f in range(m)]
    bins = np.column_stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(m)])
    start = math.log((y.sum() + 1) / (n - y.sum() + 1))
    score = np.full(n, start)
    features_, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, wide = (1 << level) - 1, 1 << level
            best = np.zeros(wide)
            for f in range(m):
                if not len(edges[f]):
                    continue
                key = (at - first) * BINS + bins[:, f]
                gs = np.bincount(key, g, wide * BINS).reshape(wide, BINS).cumsum(axis=1)
                hs = np.bincount(key, h, wide * BINS).reshape(wide, BINS).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain = np.where((hs > 0.5) & (ht - hs > 0.5), gain, 0)[:, : len(edges[f])]
                top = gain.argmax(axis=1)
                value = gain[np.arange(wide), top]
                for node in np.flatnonzero(value > best + 1e-9):
                    best[node] = value[node]
                    feature[first + node], threshold[first + node] = f, edges[f][top[node]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        leaf = np.bincount(at - inner, g, inner + 1) / (np.bincount(at - inner, h, inner + 1) + 1) * RATE
        score += leaf[at - inner]
        features_.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Boosted(start, np.array(features_), np.array(thresholds), np.array(leaves))


# --- decoding ------------------------------------------------------------------


def decoded(page: Page, log_odds: np.ndarray) -> list[bool]:
    """The nodes kept: the best sum of log odds among sets in which a kept node's parent is kept; the body always is."""
    n = len(page.tag)
    best = np.clip(log_odds, -6, 6).tolist()
    full = [False] * n  # whether anything lies in the subtree
    for node, _, _ in page.runs:
        full[node] = True
    for i in range(n - 1, 0, -1):
        if not full[i]:
            best[i] = 0.0
            continue
        full[page.parent[i]] = True
        if best[i] > 0:  # by now with its kept children
            best[page.parent[i]] += best[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and best[i] > 0
    return kept


def main_texts(sources: list[str | None], model: Boosted) -> list[str]:
    """The main text of every page: its kept runs in page order, one per line; empty if none."""
    pages = [parse(s or "") for s in sources]
    rows = [features(p) for p in pages]
    odds = model.log_odds(np.concatenate(rows)) if rows else np.empty(0)
    out, at = [], 0
    for page in pages:
        kept = decoded(page, odds[at : at + len(page.tag)])
        at += len(page.tag)
        out.append("\n".join(text for node, text, _ in page.runs if kept[node]))
    return out


# --- labelled pages --------------------------------------------------------------

MAIN = "\ue000"  # marks main text in training pages


def training_pages(n: int = TRAINING_PAGES, seed: int = 7) -> Iterator[str]:
    """Pages of random layouts; every run of main text begins with the mark."""
    r = random.Random(seed)
    syllables = [c + v for c in "bdfglmnprstv" for v in ("a", "e", "i", "o", "u", "an", "er", "il", "ón")]
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))
    phrase = lambda low, high: " ".join(word() for _ in range(r.randint(low, high)))

    def sentence(low: int = 4, high: int = 18) -> str:
        return phrase(low, high).capitalize() + r.choice("...?!")

    def prose() -> str:
        parts = [sentence(1, 22) for _ in range(r.choice([1, 1, 2, 3, 5, 8]))]
        return " ".join(f"<{t}>{p}</{t}>" if r.random() < 0.1 and (t := r.choice(["b", "em", "a href='/x'"])) and t[0] != "a" else p for p in parts)

    def link() -> str:
        return f'<a href="/{word()}">{phrase(1, 4)}</a>'

    def box(tags: list[str], names: list[str], inside: str) -> str:
        """In an element of its own kind, or in a neutral one that only its class tells."""
        if r.random() < 0.5:
            tag, attribute = r.choice(tags), f' class="{r.choice(names)}"' if r.random() < 0.3 else ""
        else:
            tag, attribute = r.choice(["div", "div", "section"]), f' {r.choice(["class", "class", "id"])}="{r.choice(names)}"'
        return f"<{tag}{attribute}>{inside}</{tag}>"

    def link_list() -> str:
        rows = [link() for _ in range(r.randint(2, 9))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in rows) + "</ul>" if r.random() < 0.7 else " | ".join(rows)

    def menu() -> str:
        return box(["nav"], ["nav", "menu", "main-nav", "navbar", "breadcrumbs", "topbar"], link_list())

    def banner() -> str:
        return box(["header"], ["header", "site-header", "masthead", "top-banner"], f"<div>{phrase(1, 4)}</div>" + (menu() if r.random() < 0.5 else sentence()))

    def footer() -> str:
        return box(["footer"], ["footer", "site-footer", "bottom", "copyright"], f"&copy; {word()}.example &middot; {sentence()}" + (link_list() if r.random() < 0.4 else ""))

    def sidebar() -> str:
        return box(["aside"], ["sidebar", "widget", "related-links", "right-side"], f"<h3>{phrase(1, 3)}</h3>" + r.choice([link_list(), f"<p>{sentence()}</p>" * r.randint(1, 3)]))

    def advert() -> str:
        inside = r.choice([sentence(), f"<p>{sentence()} {sentence()}</p>", link() + " " + sentence()])
        return f'<{(t := r.choice(["div", "div", "aside"]))} class="{r.choice(["ad", "ads", "advert", "sponsored", "promo", "ad-slot banner"])}">{inside}</{t}>'

    def notice() -> str:
        inside = f"<p>{' '.join(sentence() for _ in range(r.randint(1, 4)))}</p><button>{word()}</button>"
        return f'<div {r.choice(["class", "id"])}="{r.choice(["cookie-notice", "cookie-consent", "notice", "gdpr", "popup", "newsletter-signup", "alert"])}">{inside}</div>'

    def form() -> str:
        return f'<form><label>{phrase(1, 3)}</label><input type="text"><button>{word()}</button>{sentence() if r.random() < 0.3 else ""}</form>'

    def comments() -> str:
        one = lambda: f'<{(t := r.choice(["div", "li", "article"]))} class="comment"><b>{word()}</b><p>{prose()}</p></{t}>'
        inside = f"<h2>{phrase(1, 2)}</h2>" + "".join(one() for _ in range(r.randint(1, 8))) + (form() if r.random() < 0.4 else "")
        return box(["section", "div", "aside"], ["comments", "reader-comments", "comment-list", "discussion"], inside) if r.random() < 0.85 else f'<ol class="comments">{inside}</ol>'

    def article() -> str:
        parts = []
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 12, 20])):
            kind = r.random()
            if kind < 0.82:
                parts.append(f"<p>{MAIN}{prose()}" + ("</p>" if r.random() < 0.85 else "<br>"))
            elif kind < 0.88:
                parts.append(f"<h{(k := r.randint(2, 3))}>{MAIN}{phrase(1, 7)}</h{k}>")
            elif kind < 0.92:
                parts.append("<ul>" + "".join(f"<li>{MAIN}{sentence()}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.95:
                parts.append(f"<blockquote>{MAIN}{prose()}</blockquote>")
            elif kind < 0.97:
                parts.append(f"<table><tr><td>{MAIN}{word()}</td><td>{MAIN}{phrase(1, 4)}</td></tr></table>")
            else:
                parts.append(f"<div>{MAIN}{prose()}</div>")
            if r.random() < 0.05:
                parts.append(r.choice([advert, form, sidebar, notice])())
        title = f"<h1>{MAIN}{phrase(2, 12)}</h1>" if r.random() < 0.85 else ""
        if title and r.random() < 0.15:
            title = f"<header>{title}</header>"
        body = title + "".join(parts)
        if r.random() < 0.15:
            body += comments()
        if r.random() < 0.6:
            return f"<{(t := r.choice(['article', 'article', 'main']))}>{body}</{t}>"
        body = f'<div class="{r.choice(["content", "post", "entry-content", "article-body", "story", "main-text", "row", "col x1", "box"])}">{body}</div>'
        return f"<div>{body}</div>" if r.random() < 0.4 else body

    for _ in range(n):
        front = [f() for f in (banner, menu, notice, advert, form) if r.random() < 0.45]
        back = [f() for f in (comments, sidebar, advert, menu, form, notice) if r.random() < 0.3]
        r.shuffle(front)
        r.shuffle(back)
        core = front + [article()] + back + ([footer()] if r.random() < 0.8 else [])
        if r.random() < 0.3:
            core = [f'<div class="{r.choice(["page", "wrapper", "container", "site"])}">{"".join(core)}</div>']
        yield f"<html><head><title>{word()}</title></head><body>{''.join(core)}" + ("</body></html>" if r.random() < 0.8 else "")


@lru_cache
def fitted(n: int = TRAINING_PAGES, seed: int = 7) -> Boosted:
    """The trees, fitted on n labelled pages: a node is positive if main text lies in its subtree."""
    rows, labels = [], []
    for source in training_pages(n, seed):
        page = parse(source)
        label = np.zeros(len(page.tag))
        page.runs = [(node, text.replace(MAIN, ""), links) for node, text, links in _labelled(page, label)]
        for i in range(len(label) - 1, 0, -1):
            label[page.parent[i]] = max(label[page.parent[i]], label[i])
        full = np.zeros(len(label), bool)
        full[[node for node, _, _ in page.runs]] = True
        for i in range(len(label) - 1, 0, -1):
            full[page.parent[i]] |= full[i]
        rows.append(features(page)[full])
        labels.append(label[full])
    return boosted(np.concatenate(rows), np.concatenate(labels))


def _labelled(page: Page, label: np.ndarray) -> list[tuple[int, str, int]]:
    for node, text, _ in page.runs:
        if MAIN in text:
            label[node] = 1
    return page.runs


# --- Spark -------------------------------------------------------------------------


def extracted(pages: DataFrame) -> DataFrame:
    """(id, url, text) of pages(id, url, html): the main text, empty for a null or empty page or one without main text.

    Pages are read whole. Repeated rows give equal texts each, null ids and urls stay null, an empty table stays
    empty, and other columns are not read.
    """
    sent = pages.sparkSession.sparkContext.broadcast(fitted())

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                piece = batch.slice(at, SLICE)
                texts = main_texts(piece.column("html").to_pylist(), sent.value)
                yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])

    return pages.select("id", "url", "html").mapInArrow(run, "id long, url string, text string")
