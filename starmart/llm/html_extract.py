"""HTML extraction: gradient-boosted trees over DOM nodes, decoded from the root down.

Every block-level node of a page is described by its subtree's density of text, links, tags and
punctuation, its tag and attribute tokens, its depth, and its place among its siblings. The trees
give the odds that a node holds article text. Decoding takes the choice of nodes with the best
total odds in which nothing is kept below a dropped node, so ancestors and descendants agree.

No labels come with the pages. The trees learn from a bounded sample of them: pages whose
markup names their article (``<article>`` or ``<main>``) give the text of articles and of what
surrounds them, and the sample is laid out anew in several ways, with and without telling tags
and attributes, so that the trees cannot lean on any one of these.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.html_dom import Node, decoded, features, parse
from starmart.llm.store import table, written
from starmart.session import scratch_dir

SAMPLE = 120  # pages that the trees learn from, the smallest by a hash of their page_id
SAMPLE_CHARS = 2_400_000  # of all pages of the sample together
LAYOUTS = 6
ROUNDS, DEPTH = 24, 5
TOGETHER = 64  # pages whose nodes are scored at once
OUTSIDE = {"nav", "footer", "aside", "header", "form", "dialog"}


def sections(page: str) -> tuple[list[tuple[str, str]], list[str]]:
    """A page's article as (tag, text) blocks and the texts around it, by its own markup."""
    nodes = parse(page)
    inside = [False] * len(nodes)
    blocks, around = [], []
    for i, node in enumerate(nodes):
        if i:
            inside[i] = (inside[node.parent] or node.tag in ("article", "main")) and node.tag not in OUTSIDE
        if not node.text:
            continue
        if inside[i] and not (node.above & 0x1FF):
            tag = nodes[node.parent].tag
            blocks.append((tag if tag in ("p", "h1", "h2", "h3", "li", "blockquote") else "p", node.text))
        else:
            around.append(node.text)
    return blocks, around


MARK = "⁠"  # stands before article text in a page laid out for learning

_PLAIN = ("div", "section", "td", "span")
_NAMES = {
    "nav": ["nav", "menu", "navbar", "main-nav", "breadcrumbs", "pagination", "toc"],
    "header": ["header", "site-header", "masthead", "topbar"],
    "footer": ["footer", "site-footer", "foot", "copyright"],
    "aside": ["sidebar", "related", "widget", "right-rail", "recommended", "popular-posts"],
    "ad": ["ad", "ads", "advert", "ad-slot", "sponsored", "promo", "banner-ad"],
    "notice": ["cookie-notice", "consent", "alert", "newsletter", "subscribe-box", "popup", "notice"],
    "comments": ["comments", "comment-list", "replies", "reader-comments", "discussion", "respond"],
    "share": ["share", "social-links", "tags", "byline"],
    "form": ["search-form", "login", "signup", "contact-form", "search"],
    "content": ["content", "article-body", "post", "entry-content", "story", "main-content", "text"],
}
_TAGS = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "content": "article",
         "comments": "section", "notice": "aside", "ad": "div", "share": "div"}


def _box(draw: random.Random, kind: str, inner: str, telling: float) -> str:
    tag = _TAGS[kind] if draw.random() < telling else draw.choice(_PLAIN[:2])
    names = ""
    if draw.random() < telling or (tag in _PLAIN and kind in ("comments", "ad", "notice", "share")):
        names = f' {draw.choice(["class", "class", "id"])}="{draw.choice(_NAMES[kind])}"'
    return f"<{tag}{names}>{inner}</{tag}>"


def _links(draw: random.Random, words: list[str], listed: bool) -> str:
    each = []
    for _ in range(draw.randint(2, 9)):
        label = html.escape(" ".join(draw.choices(words, k=draw.randint(1, 4))))
        each.append(f'<a href="/x">{label}</a>')
    return "<ul>" + "".join(f"<li>{x}</li>" for x in each) + "</ul>" if listed else " | ".join(each)


def _sentence(draw: random.Random, words: list[str], least: int, most: int) -> str:
    return html.escape(" ".join(draw.choices(words, k=draw.randint(least, most))).capitalize()) + draw.choice([".", "", "!", "."])


def laid_out(blocks: list[tuple[str, str]], around: list[str], others: list[str], draw: random.Random) -> str:
    """A page with the given article and with surroundings made of the other texts."""
    telling = draw.choice([1.0, 1.0, 0.7, 0.4])
    words = " ".join([*around, *others]).split() or ["more"]
    para = lambda: "<p>" + html.escape(draw.choice(others or around or ["More."])[: draw.randint(40, 900)]) + "</p>"
    article = []
    blocks = list(blocks)
    if blocks[0][0] == "h1" and draw.random() < 0.5:
        blocks[0] = ("h1", " ".join(blocks[0][1].split()[: draw.randint(1, 9)]))
    if draw.random() < 0.4:
        for at in sorted(draw.sample(range(1, len(blocks) + 1), min(len(blocks), draw.randint(1, 3))), reverse=True):
            blocks.insert(at, (draw.choice(["h2", "h3"]), " ".join(draw.choices(words, k=draw.randint(1, 7)))))
    for tag, text in blocks:
        body = MARK + html.escape(text)
        if draw.random() < 0.15:
            at = body.find(" ", len(body) // 2)
            body = body[:at] + ' <a href="/y">' + body[at + 1 : at + 30] + "</a> " + body[at + 30 :] if at > 0 else body
        shape = draw.random()
        if tag == "h1" and shape < 0.2:
            article.append(f"<header><h1>{body}</h1></header>")
        elif tag == "li" or (tag == "p" and shape < 0.06):
            half = body.find(" ", len(body) // 2)
            each = [body] if half < 0 else [body[:half], MARK + body[half + 1 :]]
            article.append("<ul>" + "".join(f"<li>{x}</li>" for x in each) + "</ul>")
        elif tag == "p" and shape < 0.12:
            article.append(f"<blockquote><p>{body}</p></blockquote>")
        else:
            article.append(f"<{tag}>{body}</{tag}>")
        if draw.random() < 0.06:
            article.append(_box(draw, draw.choice(["ad", "share", "aside", "notice"]), _sentence(draw, words, 3, 20), telling))
    comment = "".join(
        "<div" + (' class="comment"' if draw.random() < 0.6 else "") + f"><b>{_sentence(draw, words, 1, 2)}</b>{para()}</div>"
        for _ in range(draw.randint(1, 4)))
    comments = _box(draw, "comments", draw.choice(["<h2>Comments</h2>", "<h3>Replies</h3>", ""]) + comment, max(telling, 0.7))
    if draw.random() < 0.3:
        article.append(comments)
        comments = ""
    main = _box(draw, "content", "".join(article), telling)
    if draw.random() < 0.4:
        main = f"<main>{main}</main>" if draw.random() < 0.5 else f"<div>{main}</div>"
    form = "<label>" + _sentence(draw, words, 1, 4) + '</label><input type="text"><button>' + _sentence(draw, words, 1, 2) + "</button>"
    foot = html.escape(draw.choice(around or ["About"])[:200])
    before = [
        _box(draw, "notice", "<p>" + _sentence(draw, words, 6, 40) + "</p>", telling),
        _box(draw, "header", "<h2>" + _sentence(draw, words, 1, 4) + "</h2>" + (_links(draw, words, False) if draw.random() < 0.5 else ""), telling),
        _box(draw, "nav", _links(draw, words, draw.random() < 0.7), telling),
        _box(draw, "ad", html.escape(draw.choice(around or ["Buy"])[:200]), telling),
        _box(draw, "form", form, telling),
    ]
    after = [
        comments if draw.random() < 0.7 else "",
        _box(draw, "aside", "<h3>" + _sentence(draw, words, 1, 3) + "</h3>" + draw.choice([_links(draw, words, True), "<p>" + _sentence(draw, words, 5, 40) + "</p>"]), telling),
        _box(draw, "ad", _sentence(draw, words, 3, 25), telling),
        _box(draw, "nav", _links(draw, words, draw.random() < 0.7), telling),
        _box(draw, "form", form, telling),
    ]
    keep = lambda parts: "".join(x for x in parts if draw.random() < 0.55)
    return "<html><body>" + keep(before) + main + keep(after) + _box(draw, "footer", "&copy; " + foot, telling) + "</body></html>"


def labelled(page: str) -> tuple[list[Node], np.ndarray, list[int]]:
    """Nodes, features and labels of a page laid out for learning: 1 where article text lies below."""
    nodes = parse(page)
    holds = [MARK in node.text for node in nodes]
    for node in nodes:
        node.text = node.text.replace(MARK, "")
    for i in range(len(nodes) - 1, 0, -1):
        holds[nodes[i].parent] |= holds[i]
    return nodes, features(nodes), [int(h) for h in holds]


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows to learn from: each page laid out several times, with the texts of its neighbours."""
    for batch in batches:
        split = [s for s in (sections(p.as_py()) for p in batch.column(0)) if s[0]]
        for at, (blocks, around) in enumerate(split):
            draw = random.Random(at)
            pages = []
            for _ in range(LAYOUTS):
                other = draw.choice(split)
                pages.append(laid_out(blocks, around, [t for _, t in other[0]] + other[1], draw))
            # And much as it is: the page's own order with its own texts.
            own = "".join(f"<{t if t != 'li' else 'p'}>{MARK}{html.escape(x)}</{t if t != 'li' else 'p'}>" for t, x in blocks)
            beside = "".join(f'<div class="ad">{html.escape(t)}</div>' for t in around[:3])
            pages.append(f"<html><body>{beside}<article>{own}</article></body></html>")
            for page in pages:
                _, x, y = labelled(page)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(y, pa.float64())], ["x", "label"])


class Forest:
    """The boosted trees as arrays, scored for many rows at once."""

    def __init__(self, trees: list[tuple[float, np.ndarray]]):
        self.trees = trees  # weight, and per node: feature, threshold, left, right, prediction

    def logit(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for weight, nodes in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                feature = nodes[at, 0].astype(np.int64)
                inner = feature >= 0
                left = x[np.arange(len(x)), np.maximum(feature, 0)] <= nodes[at, 1]
                at = np.where(inner, np.where(left, nodes[at, 2], nodes[at, 3]).astype(np.int64), at)
            total += weight * nodes[at, 4]
        return 2 * total  # log odds by the loss that the trees were boosted on


def forest_of(spark: SparkSession, model) -> Forest:
    """Reads the fitted model's own files: a bounded number of trees of bounded depth."""
    path = scratch_dir(spark, "trees")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees = []
    for tree, weight in enumerate(model.treeWeights):
        own = sorted((r for r in rows if r["treeID"] == tree), key=lambda r: r["id"])
        nodes = np.full((len(own), 5), -1.0)
        for r in own:
            feature = r["split"]["featureIndex"] if r["leftChild"] >= 0 else -1
            threshold = r["split"]["leftCategoriesOrThreshold"][0] if feature >= 0 else 0.0
            nodes[r["id"]] = (feature, threshold, r["leftChild"], r["rightChild"], r["prediction"])
        trees.append((weight, nodes))
    return Forest(trees)


def learn(pages: DataFrame, sample: int = SAMPLE) -> Forest | None:
    """Trees from a sample of the pages, bounded in pages and characters; None where none of them
    names its article or each is longer than the whole sample may be."""
    spark = pages.sparkSession
    ordered = pages.select("html", F.xxhash64(F.col("page_id"), F.col("html")).alias("order"))
    ordered = ordered.where("length(html) > 0")
    room, taken = SAMPLE_CHARS, []
    for order, chars in ordered.select("order", F.length("html")).orderBy("order").limit(sample).collect():
        if chars <= room:
            room -= chars
            taken.append(order)
    pages = ordered.where(F.col("order").isin(taken)).orderBy("order").limit(len(taken)).select("html").repartition(3)
    data = written(pages.mapInArrow(_examples, "x array<double>, label double"), "examples")
    if data.select("label").distinct().count() < 2:
        return None
    data = data.select(array_to_vector("x").alias("features"), "label")
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, maxBins=32, seed=1, subsamplingRate=0.8).fit(data)
    return forest_of(spark, model)


def by_markup(nodes: list[Node]) -> np.ndarray:
    """Log odds where nothing could be learnt: everything but what its tag or names put aside."""
    return np.array([-1.0 if (n.above | n.tokens) & 0x1FF or n.tag in OUTSIDE else 1.0 for n in nodes])


def _extract(forest: Forest | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            for at in range(0, batch.num_rows, TOGETHER):
                trees = [parse(page.as_py()) for page in batch.column(2).slice(at, TOGETHER)]
                if forest is None:
                    logits = list(map(by_markup, trees))
                else:
                    rows = list(map(features, trees))
                    ends = np.cumsum([len(r) for r in rows])[:-1]
                    logits = np.split(forest.logit(np.concatenate(rows)), ends)
                texts += ["\n".join(decoded(n, g)) for n, g in zip(trees, logits, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, url and the article's text of every page, its blocks joined by line breaks.

    A null or empty page has an empty text. Repeated pages each get a row; other columns are not
    kept. Pages are parsed whole, however long.
    """
    forest = learn(pages, sample)
    whole = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return whole.mapInArrow(_extract(forest), "page_id long, url string, text string, n_chars long")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))

