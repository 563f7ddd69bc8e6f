"""Operator 9, HTML extraction with a tree-structured graphical model.

Each element of the page's tree is a node that is content or not. A node's own features (tag, words of its class, id and role,
text and link shares) give its potential, and a potential couples each node with its parent. Sum-product messages go up from
the leaves and down from the root, so every node's marginal is exact; nodes of marginal over a half give the text. Weights are
trained by gradient ascent on the likelihood of small labelled pages, which are built here and differ in wording and layout.

Potentials and messages are computed for all nodes of a batch of pages at once, one level of depth a step. Parsing follows
what matters of HTML's rules: comments, declarations and raw text elements are skipped, void elements have no children, an end tag
closes up to its open element or is ignored, and p, li, td and the like are closed by their successors. Character
references are decoded, white space inside a block becomes one space, and blocks are joined by one space in page order.
Null and empty html give an empty text. Nothing is cut; a page's memory follows its length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.common import prepare, table

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|iframe|svg|textarea|title|xmp|noframes|object"
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
#: Elements that an opening tag of the second kind closes when they are open.
CLOSED_BY = {"p": frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option", "optgroup"])}
#: What such a search for an open element does not look beyond.
SCOPE = frozenset("article section div table ul ol dl td th body html main aside nav header footer form blockquote select".split())
# Words of class, id and role that mark what a page's parts are for.
WORDS = {
    "menu": "nav menu navbar breadcrumb breadcrumbs toc pagination pager tabs skip topbar navigation",
    "head": "header masthead banner branding logo top",
    "foot": "footer copyright legal colophon bottom",
    "side": "sidebar aside related recommended widget rail complementary trending popular more",
    "note": "cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe signup promo toast",
    "ad": "ad ads advert advertisement sponsor sponsored adsense outbrain taboola promoted",
    "talk": "comment comments disqus reply replies discussion respond reader feedback reviews",
    "share": "share sharing social follow tags meta byline author rating",
    "form": "search login form signin register subscribe",
    "text": "article content post entry story main body text page prose blog",
}
TAGS = ["html", "body", "main", "article", "section", "div", "nav", "header", "footer", "aside", "form", "ul", "ol", "li", "p", "h1", "h2", "h3", "table", "tr", "td", "blockquote", "pre", "figure", "figcaption", "button", "select", "a", "dialog", "inline", "dl", "menu", "head", "input"]
TAG_AT = {t: i for i, t in enumerate(TAGS)}
WORD_AT = {w: i for i, ws in enumerate(WORDS.values()) for w in ws.split()}
N_TAG, N_WORD = len(TAGS) + 1, len(WORDS)
N_FEATURES = N_TAG + N_WORD + 4

TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S | re.I)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


def parse(page: str) -> tuple[list[tuple[int, str, str, int]], list[tuple[int, str]]]:
    """Nodes (parent, tag, attributes, depth), parents first, and the texts in page order as (node, raw text or a block's edge)."""
    nodes: list[tuple[int, str, str, int]] = [(-1, "html", "", 0)]
    texts: list[tuple[int, str]] = []
    stack = [0]
    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            texts.append((stack[-1], page[at : m.start()]))
        at = m.end()
        name = m[3]
        if not name:
            continue
        name = name.lower()
        block = name not in INLINE
        if block:
            texts.append((-1, " "))
        if m[2]:
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]][1] == name:
                    del stack[k:]
                    break
            continue
        if name == "html":
            continue
        if block:
            for k in range(len(stack) - 1, 0, -1):
                open_ = nodes[stack[k]][1]
                if name in CLOSED_BY.get(open_, ()):
                    del stack[k:]
                    break
                if open_ in SCOPE:
                    break
        nodes.append((stack[-1], name, m[4] or "", len(stack)))
        if name not in VOID and not (m[4] or "").endswith("/"):
            stack.append(len(nodes) - 1)
    if at < len(page):
        texts.append((stack[-1], page[at:]))
    return nodes, texts


class Batch:
    """The trees of several pages as arrays, and the features of all nodes."""

    def __init__(self, pages: list[str]) -> None:
        parent, depth, tag, words, hidden, self.texts, self.first = [], [], [], [], [], [], []
        known: dict[str, tuple[list[int], bool]] = {}
        for page in pages:
            nodes, texts = parse(page)
            base = len(parent)
            self.first.append(base)
            self.texts.append([(n + base if n >= 0 else -1, t) for n, t in texts])
            for p, name, attributes, d in nodes:
                parent.append(p + base if p >= 0 else -1)
                depth.append(d)
                tag.append(TAG_AT.get(name, TAG_AT["inline"] if name in INLINE else N_TAG - 1))
                if attributes not in known:
                    if len(known) > 10_000:
                        known.clear()
                    found = {WORD_AT[w.lower()] for g in NAMED.findall(attributes) for w in SPLIT.split(" ".join(g)) if w.lower() in WORD_AT}
                    known[attributes] = sorted(found), bool(HIDDEN.search(attributes))
                words.append(known[attributes][0])
                hidden.append(known[attributes][1])
        n = len(parent)
        self.parent, self.depth = np.array(parent, np.int64), np.array(depth, np.int64)
        size, link = np.zeros(n), np.zeros(n)
        for texts in self.texts:
            for k, t in texts:
                if k >= 0:
                    size[k] += len(t.strip())
        tag = np.array(tag, np.int64)
        link[tag == TAG_AT["a"]] = size[tag == TAG_AT["a"]]
        # Text and link text below each node, level by level.
        self.levels = [np.flatnonzero(self.depth == d) for d in range(int(self.depth.max(initial=0)) + 1)]
        for level in reversed(self.levels[1:]):
            np.add.at(size, self.parent[level], size[level])
            np.add.at(link, self.parent[level], link[level])
        x = np.zeros((n, N_FEATURES), np.float32)
        x[np.arange(n), tag] = 1
        for i, ws in enumerate(words):
            for w in ws:
                x[i, N_TAG + w] = 1
        x[:, N_TAG + N_WORD] = np.log1p(size) / 5
        x[:, N_TAG + N_WORD + 1] = link / np.maximum(size, 1)
        x[:, N_TAG + N_WORD + 2] = hidden
        x[:, N_TAG + N_WORD + 3] = 1
        self.x, self.n = x, n

    def marginals(self, weights: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum-product: log odds of each node being content, and the expected counts of (parent, child) states."""
        unary = np.zeros((self.n, 2))
        unary[:, 1] = self.x @ weights
        up = np.zeros((self.n, 2))  # message of a node to its parent
        below = unary.copy()  # own potential and the messages from below
        for level in reversed(self.levels[1:]):
            up[level] = np.logaddexp(pair[:, 0] + below[level][:, :1], pair[:, 1] + below[level][:, 1:])
            up[level] -= up[level].max(axis=1, keepdims=True)
            np.add.at(below, self.parent[level], up[level])
        belief = below.copy()
        expected = np.zeros((2, 2))
        for level in self.levels[1:]:
            p = self.parent[level]
            rest = belief[p] - up[level]  # all that the parent knows but from this child
            down = np.logaddexp(rest[:, :1] + pair[0], rest[:, 1:] + pair[1])
            joint = rest[:, :, None] + pair + below[level][:, None, :]
            joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            belief[level] = below[level] + down - down.max(axis=1, keepdims=True)
        return belief[:, 1] - belief[:, 0], expected

    def extract(self, odds: np.ndarray) -> list[str]:
        out = []
        for texts in self.texts:
            raw = "".join(t for k, t in texts if k < 0 or odds[k] > 0)
            out.append(" ".join(html.unescape(raw).split()))
        return out


def labelled_pages() -> list[str]:
    """Small pages of several layouts; an element with data-y="1" is content, with "0" not, and so is all below it."""
    pages = []
    words = "the river town opened a new bridge after long works and many people came to see it on sunday".split()

    def prose(n: int, k: int) -> str:
        return " ".join(words[(k * 7 + i * (1 + k % 3)) % len(words)] for i in range(n)).capitalize() + "."

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{words[i % len(words)]}</a></li>' for i in range(n)) + "</ul>"

    bad = [
        '<nav data-y="0">{l}</nav>', '<div class="menu" data-y="0">{l}</div>', '<header data-y="0"><h1>{s}</h1>{l}</header>', '<div id="header" data-y="0"><p>{s}</p></div>',
        '<aside data-y="0"><h3>{s}</h3><p>{m}</p>{l}</aside>', '<div class="sidebar" data-y="0"><p>{m}</p>{l}</div>', '<div class="ad" data-y="0">{m}</div>', '<section class="advertisement" data-y="0"><p>{m}</p></section>',
        '<div class="cookie-notice" data-y="0"><p>{m}</p><button>OK</button></div>', '<div role="alert" class="notice" data-y="0">{m}</div>', '<form data-y="0"><p>{s}</p><input name="q"><button>Go</button></form>',
        '<section class="comments" data-y="0"><h2>Comments</h2><div class="comment"><p>{m}</p></div><div class="comment"><p>{b}</p></div></section>', '<div id="comments" data-y="0"><ol><li><p>{b}</p></li><li><p>{m}</p></li></ol></div>',
        '<footer data-y="0">{m}{l}</footer>', '<div class="footer" data-y="0"><p>&copy; {s}</p></div>', '<div class="share" data-y="0">{l}</div>', '<div class="related" data-y="0"><h3>{s}</h3>{l}</div>', '<dialog data-y="0"><p>{m}</p></dialog>', '<menu data-y="0">{l}</menu>',
        '<ul class="breadcrumb" data-y="0"><li><a href="/">{s}</a></li></ul>', '<div class="newsletter" data-y="0"><p>{m}</p><form><input></form></div>', '<div data-y="0">{l}</div>',
        '<nav data-y="0"><p>{m}</p>{l}</nav>', '<header data-y="0"><p>{b}</p></header>', '<aside data-y="0"><p>{b}</p><p>{m}</p></aside>', '<form data-y="0"><p>{b}</p><label>{m}</label><select><option>{s}</select></form>', '<footer data-y="0"><p>{b}</p></footer>',
        '<section id="comments" data-y="0"><article><p>{b}</p></article><article><p>{m}</p></article></section>', '<div class="reader-comments" data-y="0"><div><p>{b}</p></div></div>', '<aside class="ad" data-y="0">{m}</aside>', '<div class="banner ads" data-y="0"><p>{b}</p></div>', '<div class="notice" data-y="0"><p>{b}</p></div>',
        '<div class="popup" data-y="0"><p>{b}</p></div>', '<div id="sidebar" data-y="0"><div><p>{b}</p></div></div>',
    ]
    good = [
        '<article data-y="1"><h1>{s}</h1><p>{b}</p><p><b>{b}<br><p>{m}</p><p>{s}</p>{in}</article>', '<main data-y="1"><h1>{s}</h1><p>{b}</p><h2>{s}</h2><p>{m} <a href="/x">{s}</a></p><ul><li>{s}</li><li>{m}</li></ul>{in}</main>',
        '<div class="content" data-y="1"><h2>{s}</h2><p>{b}</p><blockquote><p>{m}</p></blockquote><p>{b}</p>{in}</div>', '<div id="article-body" data-y="1"><p>{b}</p><table><tr><td>{s}</td><td>{s}</td></tr></table><p>{m}</p>{in}</div>',
        '<div class="post" data-y="1"><h1>{s}</h1><div class="entry"><p>{b}</p><pre>{m}</pre><p><em>{s}</em></p></div>{in}</div>', '<section class="story" data-y="1"><h1>{s}</h1><p>{b}</p><figure><img src="a"><figcaption>{s}</figcaption></figure><p>{b}</p>{in}</section>',
        '<article data-y="1"><p>{b}</p>{in}</article>', '<article data-y="1"><header><h1>{s}</h1></header><p>{m}</p><p>{b}</p>{in}</article>', '<main data-y="1"><article><h1>{s}</h1><p>{s}</p>{in}</article></main>', '<article data-y="1">{b}<br>{m}{in}</article>', '<main data-y="1"><p>{m}</p>{in}</main>',
        '<div data-y="1"><h1>{s}</h1><p>{b}</p><p>{b}</p><p>{m}</p>{in}</div>', '<article data-y="1"><h1>{s}</h1><section><h2>{s}</h2><p>{b}</p></section><section><p>{m}</p></section>{in}</article>', '<article data-y="1"><p>{s}</p></article>',
    ]

    def fill(t: str, k: int, inner: str = "") -> str:
        return t.replace("{in}", inner).replace("{l}", links(2 + k % 5)).replace("{s}", prose(1 + k % 5, k)).replace("{m}", prose(6 + k % 9, k + 1)).replace("{b}", prose(20 + 13 * (k % 5), k + 2))

    for k in range(170):
        first, last, inner = bad[(3 * k) % len(bad)], bad[(5 * k + 7) % len(bad)], bad[(k + 4) % len(bad)] if k % 2 else ""
        body = fill(bad[k % len(bad)], k) + fill(first, k + 1) + fill(good[k % len(good)], k, fill(inner, k + 3)) + fill(last, k + 2)
        if k % 3 == 0:
            body = f'<div class="page"><div id="wrap">{body}</div></div>'
        pages.append(f"<html><head><title>{prose(3, k)}</title></head><body>{body}</body></html>")
    return pages


def train(steps: int = 300, rate: float = 0.5, decay: float = 2e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the node features and of (parent, child) states: gradient ascent on the pages' log likelihood."""
    pages = labelled_pages()
    batch = Batch(pages)
    said = np.full(batch.n, -1)
    k = 0
    for page in pages:
        for _, _, attributes, _ in parse(page)[0]:
            m = re.search(r'data-y="([01])"', attributes)
            said[k] = int(m[1]) if m else -1
            k += 1
    y = np.zeros(batch.n)
    for level in batch.levels[1:]:
        y[level] = np.where(said[level] >= 0, said[level], y[batch.parent[level]])
    weights, pair = np.zeros(N_FEATURES), np.zeros((2, 2))
    observed = np.zeros((2, 2))
    child = batch.parent >= 0
    np.add.at(observed, (y[batch.parent[child]].astype(int), y[child].astype(int)), 1)
    speed_w, speed_p = np.zeros(N_FEATURES), np.zeros((2, 2))
    for _ in range(steps):
        odds, expected = batch.marginals(weights, pair)
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        g = batch.x.T @ (y - p) / len(pages) - decay * weights
        h = (observed - expected) / len(pages) - decay * pair
        speed_w, speed_p = speed_w + g * g, speed_p + h * h
        weights += rate * g / np.sqrt(speed_w + 1e-6)
        pair += rate * h / np.sqrt(speed_p + 1e-6)
    return weights, pair


def _extract(weights: np.ndarray, pair: np.ndarray, step: int = 200):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column("html").to_pylist()
            out: list[str] = []
            for i in range(0, len(pages), step):
                some = Batch([p or "" for p in pages[i : i + step]])
                out += some.extract(some.marginals(weights, pair)[0])
            rest = [c for c in batch.schema.names if c != "html"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=[*rest, "text", "n_chars"])

    return run


def main_text(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """The columns `keep`, text and n_chars of each page."""
    prepare(pages.sparkSession)
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return pages.select(*keep, pages[html_col].alias("html")).mapInArrow(_extract(*train()), f"{kinds}, text string, n_chars long")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"), ["page_id", "url"])
