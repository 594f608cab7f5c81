"""Block-level trees of web pages, and the features of their nodes.

A node is a block element or a run of text beside block elements. Inline markup only counts
towards the node it stands in. Pages are parsed as browsers do in the main: raw-text elements,
optional end tags, unclosed and stray tags.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from math import log1p

import numpy as np

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)")
ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PART = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "iframe", "textarea", "title"}  # to their closing tag or the page's end
PUT_ASIDE = {"noscript", "template", "select", "svg", "canvas"}  # dropped where they are closed
TAG_GROUPS = (
    ("nav", "menu"),
    ("footer",),
    ("header",),
    ("aside",),
    ("form", "fieldset", "button", "label", "dialog"),
    ("article",),
    ("main",),
    ("p",),
    ("h1", "h2", "h3", "h4", "h5", "h6"),
    ("ul", "ol", "dl"),
    ("li", "dt", "dd"),
    ("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"),
    ("div", "section", "details", "summary", "address", "center"),
    ("blockquote", "pre", "figure", "figcaption"),
    ("html", "body", "head"),
    ("#text",),
)
GROUP = {tag: i for i, tags in enumerate(TAG_GROUPS) for tag in tags}
BLOCK = set(GROUP)
# An open element of the first kind ends where one of the second starts.
CLOSES = {
    "p": BLOCK - {"html", "body", "head"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "thead", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
    "head": {"body"},
}
SCOPE = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "blockquote", "nav", "aside"}
TOKEN_GROUPS = (
    ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner"),
    ("nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "skip"),
    ("footer", "foot", "copyright", "legal", "colophon"),
    ("header", "masthead", "topbar", "top", "logo", "head"),
    ("sidebar", "side", "widget", "related", "rail", "aside", "recommended", "popular", "complementary"),
    ("cookie", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "gdpr", "overlay", "warning"),
    ("comment", "comments", "reply", "replies", "respond", "discussion", "disqus", "reader", "readers"),
    ("share", "social", "follow", "tags", "byline", "meta"),
    ("search", "form", "login", "signup", "signin", "contact"),
    ("content", "article", "post", "entry", "story", "main", "body", "text", "prose"),
)
TOKEN_OF = {token: i for i, tokens in enumerate(TOKEN_GROUPS) for token in tokens}
FEATURES = 26 + len(TAG_GROUPS) + 2 * len(TOKEN_GROUPS)


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: int  # bits of TOKEN_GROUPS
    above: int  # the same of all ancestors, their tags included
    text: str = ""
    tags: int = 0
    links: int = 0  # characters within links
    place: int = 0  # among its siblings
    children: list[int] = field(default_factory=list)


_TAG_BITS = {"nav": 1 << 1, "menu": 1 << 1, "footer": 1 << 2, "header": 1 << 3, "aside": 1 << 4, "form": 1 << 8,
             "dialog": 1 << 5, "article": 1 << 9, "main": 1 << 9}


def _bits(attributes: str) -> int:
    bits = 0
    if "=" in attributes:
        for values in ATTRIBUTE.findall(attributes):
            for token in PART.findall(CAMEL.sub(" ", "".join(values)).lower()):
                if token in TOKEN_OF:
                    bits |= 1 << TOKEN_OF[token]
    return bits


def closings(page: str, name: str) -> dict[int, int]:
    """Where each element of that name ends, by where its tag ends; unclosed ones are left out."""
    either = re.compile(
        rf"<!--.*?(?:-->|\Z)|<(script|style|textarea|title)\b.*?(?:</\1\b[^>]*>|\Z)"
        rf"|<(/?){re.escape(name)}(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>", re.S | re.I)
    ends: dict[int, int] = {}
    opened: list[int] = []
    for found in either.finditer(page):
        if found.group(2) is None:
            continue
        if not found.group(2):
            if not found.group().endswith("/>"):
                opened.append(found.end())
        elif opened:
            ends[opened.pop()] = found.end()
    return ends


def parse(page: str) -> list[Node]:
    """The page's nodes in the order in which they start; the first is the root."""
    nodes = [Node("html", -1, 0, 0, 0)]
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements; -1 for inline ones
    run: list[str] = []
    linked = 0
    at, end = 0, len(page)
    ends: dict[str, dict[int, int]] = {}

    def current() -> int:
        return next(k for _, k in reversed(stack) if k >= 0)

    def open_node(tag: str, tokens: int) -> int:
        up = current()
        parent = nodes[up]
        above = parent.above | parent.tokens | _TAG_BITS.get(parent.tag, 0)
        nodes.append(Node(tag, up, parent.depth + 1, tokens, above, place=len(parent.children)))
        parent.children.append(len(nodes) - 1)
        return len(nodes) - 1

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                node = nodes[open_node("#text", 0)]
                node.text, node.links = text, min(linked, len(text))
        linked = 0

    def pop_to(depth: int) -> None:
        flush()
        del stack[depth:]

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            lt = end
        if lt > at:
            run.append(page[at:lt])
            if stack[-1][0] == "a" or any(t == "a" for t, k in stack if k < 0):
                linked += lt - at
        if lt == end:
            break
        found = TOKEN.match(page, lt) or LOOSE.match(page, lt)
        if not found:
            run.append("<")
            at = lt + 1
            continue
        at = found.end()
        if found.re is TOKEN and found.lastindex is None:
            continue  # a comment or declaration
        name = found.group(2).lower()
        if found.group(1):
            if name not in BLOCK and name != "a":
                nodes[current()].tags += 1
                if name in VOID:
                    run.append(" ")
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    if stack[depth][1] >= 0:
                        pop_to(depth)
                    else:
                        del stack[depth]
                    break
                if name == "a" and stack[depth][1] >= 0:
                    break
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if not found.group(3).rstrip().endswith("/"):
                at = close.end() if close else end
            run.append(" ")
            continue
        if name in PUT_ASIDE:
            if name not in ends:
                ends[name] = closings(page, name)
            if at in ends[name] or found.group(3).rstrip().endswith("/"):
                at = ends[name].get(at, at)
                run.append(" ")
                continue
        if name not in BLOCK:
            nodes[current()].tags += 1
            if name == "br" or name == "hr":
                run.append(" ")
            elif name == "a":
                stack.append(("a", -1))
            continue
        if name in ("html", "body", "head"):
            if name == "html" or any(t == name for t, _ in stack):
                continue
        flush()
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth][0]
            if name in CLOSES.get(tag, ()):
                pop_to(depth)
                break
            if tag in SCOPE:
                break
        while stack[-1][1] < 0:
            stack.pop()
        stack.append((name, open_node(name, _bits(found.group(3)))))
    flush()
    return nodes


def features(nodes: list[Node]) -> np.ndarray:
    """One row of features per node, the subtree's sums included."""
    n = len(nodes)
    chars, links, stops, commas, digits, capitals = ([0] * n for _ in range(6))
    runs, tags, below = [0] * n, [0] * n, [0] * n
    start, finish = [0] * n, [0] * n
    total = 0
    for i, node in enumerate(nodes):
        start[i] = total
        text = node.text
        tags[i] = node.tags + 1
        if text:
            total += len(text)
            chars[i], links[i], runs[i] = len(text), node.links, 1
            stops[i] = text.count(".") + text.count("!") + text.count("?")
            commas[i] = text.count(",")
            digits[i] = sum(map(str.isdigit, text))
            capitals[i] = sum(map(str.isupper, text))
        finish[i] = total
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent
        for sums in (chars, links, stops, commas, digits, capitals, runs, tags):
            sums[up] += sums[i]
        below[up] += below[i] + 1
        if finish[i] > finish[up]:
            finish[up] = finish[i]
    rows = np.zeros((n, FEATURES))
    whole = max(total, 1)
    base = 26
    tagged = [Counter(nodes[c].tag for c in node.children) for node in nodes]
    for i, node in enumerate(nodes):
        size = chars[i]
        per = 100 / (size + 20)
        up = nodes[node.parent] if i else node
        beside = up.children if i else [i]
        same = tagged[node.parent][node.tag] if i else 1
        kids = node.children
        place = node.place
        after = beside[place + 1] if place + 1 < len(beside) else -1
        rows[i, :base] = (
            min(node.depth, 20), log1p(size), links[i] / (size + 1), tags[i] * per, log1p(below[i]), log1p(len(kids)),
            size / whole, start[i] / whole, finish[i] / whole, log1p(size / max(runs[i], 1)), log1p(runs[i]),
            stops[i] * per, commas[i] * per, digits[i] * per, capitals[i] * per,
            log1p(len(beside)), same / len(beside), size / (chars[node.parent] + 1) if i else 1.0,
            log1p(chars[node.parent]) if i else log1p(size), links[node.parent] / (chars[node.parent] + 1) if i else 0.0,
            GROUP.get(up.tag, -1), float(bool(node.above & 0x1FF)), float(bool(node.above >> 9)),
            log1p(chars[after]) if after >= 0 else -1.0, links[after] / (chars[after] + 1) if after >= 0 else 0.0,
            place / len(beside),
        )
        rows[i, base + GROUP[node.tag]] = 1
        for k in range(len(TOKEN_GROUPS)):
            if node.tokens >> k & 1:
                rows[i, base + len(TAG_GROUPS) + k] = 1
            if node.above >> k & 1:
                rows[i, base + len(TAG_GROUPS) + len(TOKEN_GROUPS) + k] = 1
    return rows


def decoded(nodes: list[Node], logit: np.ndarray) -> list[str]:
    """The kept texts: the choice of nodes with the largest sum of log odds in which no node is
    kept below one that is dropped."""
    gain = logit.astype(float).tolist()
    for i in range(len(nodes) - 1, 0, -1):
        if gain[i] > 0:
            gain[nodes[i].parent] += gain[i]
    kept = [gain[0] > 0] + [False] * (len(nodes) - 1)
    for i in range(1, len(nodes)):
        kept[i] = kept[nodes[i].parent] and gain[i] > 0
    return [node.text for node, keep in zip(nodes, kept, strict=True) if keep and node.text]
