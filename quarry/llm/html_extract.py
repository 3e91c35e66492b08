"""Main-text extraction: gradient-boosted trees over DOM-node features, decoded down the tree.

A page is parsed into its block elements. Each has features of its own tag and attribute tokens, of its
ancestors, its depth, its siblings and its subtree (text, links, tags per character). MLlib's
gradient-boosted trees give each node the log-odds of being content. Decoding picks the best consistent
choice for the whole tree: a dropped node drops its subtree, and a kept node has kept ancestors.

Training uses at most ``max_pages`` pages (lowest hash of the id first) whose own mark-up has an
``article`` or ``main`` element: its nodes are content, those of navigation, footers, adverts and the
like are not. Each page is also used in variants that carry no such tag, only class tokens, and hold
further kinds of boilerplate (sidebars, notices, forms, reader comments) made of the page's own words, so
the trees learn tokens and structure as well as tags. The model is a few hundred numbers, broadcast.

Defined cases: a null, empty or tagless page gives its decoded text, or an empty string; truncated and
unclosed mark-up is closed at the end, and an unclosed or self-closed graphic, object or the like (``SKIPPED``) drops
nothing but its tag; text of formulas and buttons belongs to the block around it; repeated rows are extracted alike; without a usable training page
the article or body element decides; an empty table gives an empty result.
"""

from __future__ import annotations

import html as htmllib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ready

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title".split())  # their text is no mark-up, and ends at the closing tag or the page's end
SKIPPED = frozenset("noscript template iframe svg select object canvas audio video".split())  # dropped up to their own closing tag
FOREIGN = frozenset("svg math".split())  # here '/>' closes a tag
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"body", "html"}
SELF_NESTED = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
BAD_TAGS = frozenset("nav footer header aside form dialog menu fieldset".split())
GOOD_TAGS = frozenset("article main".split())
BAD_TOKENS = frozenset(
    "ad ads adv advert advertisement advertising aside banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer "
    "discussion disqus foot footer form gdpr head header login masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup popular promo promoted recommended related reply replies respond share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription tags toolbar topbar warning widget".split())
GOOD_TOKENS = frozenset("article body content entry main maincontent page post story text".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>|<[/!?][^>]*>|<[a-zA-Z/!?][^<>]*\Z",
    re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile(r"[a-z]+")
_HAS_SKIPPED = re.compile(rf"<(?:{'|'.join(sorted(SKIPPED))})\b", re.I)
FEATURES = ("bad_tag", "good_tag", "bad_tokens", "good_tokens", "bad_above", "good_above", "bad_tokens_above", "good_tokens_above",
            "heading", "paragraph", "item", "container", "depth", "sibling", "siblings", "alike", "bad_siblings", "log_text",
            "log_words", "link_share", "tags_per_char", "blocks", "bad_below", "good_below", "place", "share")


def _past(source: str, tag: str, at: int) -> int:
    """The place behind the closing tag of a raw-text element."""
    end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
    return end.end() if end else len(source)


def _closings(source: str) -> dict[int, int]:
    """Place behind the start tag -> place behind its own closing tag, of the ``SKIPPED`` elements that are closed.

    One pass with a stack: elements nest, and one that is still open when an element around it closes is not closed.
    """
    out: dict[int, int] = {}
    if not _HAS_SKIPPED.search(source):
        return out
    stack: list[tuple[str, int]] = []
    open_: dict[str, int] = {}
    at = 0
    while m := _TAG.search(source, at):
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            if open_.get(tag):
                while True:
                    t, start = stack.pop()
                    open_[t] -= 1
                    if t == tag:
                        break
                if tag in SKIPPED:
                    out[start] = at
        elif m.group(3).endswith("/") and (tag in FOREIGN or any(open_.get(t) for t in FOREIGN)):
            continue
        elif tag in RAW:
            at = _past(source, tag, at)
        elif tag not in VOID:
            stack.append((tag, at))
            open_[tag] = open_.get(tag, 0) + 1
    return out


class Page:
    """Block elements of a page in document order, and its text runs as (node, text, in link)."""

    def __init__(self, source: str, marker: str | None = None):
        """``marker`` names the attribute by which ``variants`` marks content; no page's own attribute is read as a mark."""
        self.mark = re.compile(rf'\s{marker}="([01])"') if marker else None
        self.parent, self.tag, self.tokens, self.label = [-1], ["root"], [frozenset()], [None]
        self.inline = [0]
        self.runs: list[tuple[int, list[str], int]] = []
        self._parse(source)

    def _parse(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("root", 0)]
        node, links, at, fresh = 0, 0, 0, True
        closings = _closings(source)
        while at < len(source):
            m = _TAG.search(source, at)
            text = source[at:m.start()] if m else source[at:]
            if text:
                if fresh or self.runs[-1][0] != node:
                    self.runs.append((node, [], [0, 0]))
                    fresh = False
                self.runs[-1][1].append(text)
                self.runs[-1][2][1 if links else 0] += len(text)
            if not m:
                break
            at = m.end()
            if m.group(2) is None:
                continue
            tag = m.group(2).lower()
            if m.group(1):
                if any(t == tag for t, _ in stack[1:]):
                    while True:
                        t, _ = stack.pop()
                        links -= t == "a"
                        if t == tag:
                            break
                    node = stack[-1][1]
                fresh = fresh or tag in BLOCK
                continue
            if tag in RAW:
                at = _past(source, tag, at)
                continue
            if tag in SKIPPED:
                at = closings.get(at, at)  # an empty or unclosed one takes nothing with it
                continue
            if tag in VOID:
                self.inline[node] += 1
                if tag in ("br", "hr") and not fresh and self.runs:
                    self.runs[-1][1].append(" ")
                continue
            if tag not in BLOCK:
                self.inline[node] += 1
                if not m.group(3).endswith("/"):
                    stack.append((tag, node))
                    links += tag == "a"
                continue
            cut = None
            if tag in CLOSES_P:
                cut = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == "p"), None)
            if tag in SELF_NESTED:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in SELF_NESTED[tag]:
                        break
                    if stack[i][0] == tag or {stack[i][0], tag} in ({"dt", "dd"}, {"td", "th"}):
                        cut = i if cut is None else min(cut, i)
                        break
            if cut is not None:
                links -= sum(t == "a" for t, _ in stack[cut:])
                del stack[cut:]
            tokens, label = set(), None
            for a in _ATTR.finditer(m.group(3)):
                value = a.group(2) or a.group(3) or a.group(4) or ""
                tokens.update(_TOKEN.findall(value.lower()))
            if self.mark and (y := self.mark.search(m.group(3))):
                label = int(y.group(1))
            self.parent.append(stack[-1][1])
            self.tag.append(tag)
            self.tokens.append(frozenset(tokens))
            self.label.append(label)
            self.inline.append(0)
            node, fresh = len(self.tag) - 1, True
            stack.append((tag, node))

    def features(self) -> np.ndarray:
        n = len(self.tag)
        x = np.zeros((n, len(FEATURES)))
        parent = self.parent
        text, link, words, tags = np.zeros(n), np.zeros(n), np.zeros(n), np.asarray(self.inline, float)
        first = np.full(n, -1.0)
        run_at = 0
        for node, parts, (plain, linked) in self.runs:
            text[node] += plain + linked
            link[node] += linked
            words[node] += sum(p.count(" ") for p in parts)
            if first[node] < 0:
                first[node] = run_at
            run_at += plain + linked
        kids: list[list[int]] = [[] for _ in range(n)]
        for i in range(1, n):
            kids[parent[i]].append(i)
        bad = np.array([t in BAD_TAGS for t in self.tag], float)
        good = np.array([t in GOOD_TAGS for t in self.tag], float)
        bad_tok = np.array([len(t & BAD_TOKENS) for t in self.tokens], float)
        good_tok = np.array([len(t & GOOD_TOKENS) for t in self.tokens], float)
        blocks, bad_below, good_below = np.ones(n), np.zeros(n), np.zeros(n)
        for i in range(n - 1, 0, -1):
            p = parent[i]
            text[p] += text[i]
            link[p] += link[i]
            words[p] += words[i]
            tags[p] += tags[i] + 1
            blocks[p] += blocks[i]
            bad_below[p] += bad_below[i] + (bad[i] > 0 or bad_tok[i] > 0)
            good_below[p] += good_below[i] + (good[i] > 0 or good_tok[i] > 0)
            if first[i] >= 0 and (first[p] < 0 or first[i] < first[p]):
                first[p] = first[i]
        depth, above = np.zeros(n), np.zeros((n, 4))
        x[:, 0], x[:, 1], x[:, 2], x[:, 3] = bad, good, np.minimum(bad_tok, 2), np.minimum(good_tok, 2)
        for i in range(1, n):
            p = parent[i]
            depth[i] = depth[p] + 1
            above[i] = np.maximum(above[p], x[p, :4] > 0)
        x[:, 4:8] = above
        for i, t in enumerate(self.tag):
            x[i, 8:12] = (len(t) == 2 and t[0] == "h" and t[1].isdigit(), t == "p", t in ("li", "dd", "dt", "td", "th"),
                          t in ("div", "section", "body", "html", "root"))
        for group in kids:
            marks = sum(bad[i] > 0 or bad_tok[i] > 0 for i in group)
            same: dict[str, int] = {}
            for i in group:
                same[self.tag[i]] = same.get(self.tag[i], 0) + 1
            for k, i in enumerate(group):
                x[i, 13:17] = k / len(group), min(len(group), 20), same[self.tag[i]] / len(group), marks / len(group)
        total = max(text[0], 1)
        x[:, 12] = np.minimum(depth, 12)
        x[:, 17], x[:, 18] = np.log1p(text), np.log1p(words)
        x[:, 19], x[:, 20] = link / np.maximum(text, 1), tags / (text + 10)
        x[:, 21], x[:, 22], x[:, 23] = np.minimum(blocks, 50), np.minimum(bad_below, 5), np.minimum(good_below, 5)
        x[:, 24], x[:, 25] = np.maximum(first, 0) / total, text / total
        return x

    def marked(self) -> np.ndarray:
        """Training labels from the mark-up, the marker first: 1 content or a holder of content, 0 not, -1 unused."""
        n = len(self.tag)
        y = np.full(n, -1)
        for i in range(n):
            if self.label[i] is not None:
                y[i] = self.label[i]
            elif self.tag[i] in GOOD_TAGS:
                y[i] = 1
            elif self.tag[i] in BAD_TAGS or self.tokens[i] & BAD_TOKENS:
                y[i] = 0
            elif i:
                y[i] = y[self.parent[i]]
            if i and y[self.parent[i]] == 0:
                y[i] = 0
        for i in range(n - 1, 0, -1):
            if y[i] == 1:
                y[self.parent[i]] = 1
        return y

    def decode(self, odds: np.ndarray) -> np.ndarray:
        """Kept nodes: the consistent choice with the largest sum of log-odds; the root is kept."""
        n = len(self.tag)
        keep, drop = odds.astype(float).copy(), -odds.astype(float)
        for i in range(n - 1, 0, -1):
            keep[self.parent[i]] += max(keep[i], drop[i])
            drop[self.parent[i]] += drop[i]
        out = np.zeros(n, bool)
        out[0] = True
        for i in range(1, n):
            out[i] = out[self.parent[i]] and keep[i] > drop[i]
        return out

    def text(self, kept: np.ndarray) -> str:
        parts = (" ".join(htmllib.unescape("".join(p)).split()) for node, p, _ in self.runs if kept[node])
        return " ".join(p for p in parts if p)


class Trees:
    """Boosted regression trees as arrays: log-odds of a node being content."""

    def __init__(self, trees: list[tuple]):
        self.trees = trees  # (weight, feature, threshold, left, right, value)

    def odds(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for weight, feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                inner = np.flatnonzero(feature[at] >= 0)
                if not len(inner):
                    break
                a = at[inner]
                at[inner] = np.where(x[inner, feature[a]] <= threshold[a], left[a], right[a])
            out += weight * value[at]
        return 2 * out  # boosted margins are half the log-odds

    @classmethod
    def of(cls, model) -> "Trees":
        trees = []
        for weight, tree in zip(model.treeWeights, model.trees):
            rows: list[list] = []

            def visit(node):
                me = len(rows)
                rows.append([-1, 0.0, 0, 0, node.prediction()])
                if node.subtreeDepth() > 0:
                    split = node.split()
                    rows[me][:2] = split.featureIndex(), split.threshold()
                    rows[me][2] = visit(node.leftChild())
                    rows[me][3] = visit(node.rightChild())
                return me

            visit(tree._java_obj.rootNode())
            cols = list(zip(*rows))
            trees.append((weight, np.array(cols[0]), np.array(cols[1]), np.array(cols[2]), np.array(cols[3]), np.array(cols[4])))
        return cls(trees)


# Boilerplate kinds for the training variants, as (open tag, close tag).
_KINDS = (
    ('<aside class="sidebar">', "</aside>"), ('<div class="sidebar widget">', "</div>"), ('<header class="masthead">', "</header>"),
    ('<div id="header">', "</div>"), ('<div class="cookie-notice">', "</div>"), ('<div role="dialog" class="consent">', "</div>"),
    ('<section class="comments">', "</section>"), ('<div id="comments">', "</div>"), ('<form class="signup">', "</form>"),
    ("<form>", "</form>"), ('<div class="related-posts">', "</div>"), ('<div class="newsletter">', "</div>"),
    ('<div class="advertisement">', "</div>"), ('<div class="promo banner">', "</div>"), ('<ul class="breadcrumb">', "</ul>"),
    ('<div class="share social">', "</div>"), ("<aside>", "</aside>"), ("<header>", "</header>"), ('<div class="notice">', "</div>"),
)
_WRAPS = (
    ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="main">', "</div>"),
    ('<section class="post-body">', "</section>"), ('<div class="entry story">', "</div>"), ("<main><article>", "</article></main>"),
)


def variants(source: str, seed: int, marker: str) -> list[str]:
    """The page itself and two rewritten pages, with their content and added blocks marked by the attribute ``marker``."""
    rng = np.random.default_rng(seed)
    m = re.search(r"<(article|main)\b[^>]*>(.*?)(?:</\1\s*>|\Z)", source, re.S | re.I)
    if not m:
        return []
    words = re.sub(r"<[^>]*>", " ", m.group(2)).split()
    mark = lambda tag, y: tag.replace(">", f' {marker}="{y}">', 1)

    def block():
        a, b = _KINDS[rng.integers(len(_KINDS))]
        inner = []
        for _ in range(int(rng.integers(1, 5))):
            k = int(rng.integers(0, max(len(words) - 5, 1)))
            some = " ".join(words[k:k + int(rng.integers(2, 60))])
            inner.append((f"<p>{some}</p>", f"<li><a href=x>{some[:40]}</a></li>", f"<div>{some}</div>")[rng.integers(3)])
        return mark(a, 0) + "".join(inner) + b

    out = [source]
    for _ in range(2):
        a, b = _WRAPS[rng.integers(len(_WRAPS))]
        before = "".join(block() for _ in range(int(rng.integers(0, 3))))
        after = "".join(block() for _ in range(int(rng.integers(0, 3))))
        inside = block() if rng.random() < 0.4 else ""
        page = source[:m.start()] + before + mark(a, 1) + m.group(2) + inside + b + after + source[m.end():]
        if rng.random() < 0.5:
            page = re.sub(r"<(/?)nav\b", lambda t: "</div" if t.group(1) else f'<div class="menu" {marker}="0"', page)
            page = re.sub(r"<(/?)footer\b", lambda t: "</div" if t.group(1) else f'<div id="footer" {marker}="0"', page)
        out.append(page)
    return out


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = 300) -> Trees | None:
    """Trees from at most ``max_pages`` pages and their variants; None when no page can be used."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    marker = f"data-{uuid.uuid4().hex}"  # of this fit alone: no page holds it

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = [], []
            for source, seed in zip(*(c.to_pylist() for c in batch.columns)):
                for v in variants(source, seed, marker):
                    page = Page(v, marker)
                    y = page.marked()
                    xs.append(page.features()[y >= 0])
                    ys.append(y[y >= 0])
            if xs:
                yield pa.RecordBatch.from_arrays([pa.array(list(np.concatenate(xs)), pa.list_(pa.float64())),
                                                  pa.array(np.concatenate(ys).astype(float))], ["x", "label"])

    chosen = (pages.select(F.col(html_col).cast("string").alias("html"), F.pmod(F.xxhash64(id_col, F.lit(3)), F.lit(1 << 40)).alias("seed"))
              .where("html rlike '(?i)<(article|main)'").orderBy("seed", F.xxhash64("html")).limit(max_pages))
    data = ready(chosen).repartition(4, "seed").mapInArrow(rows, "x array<double>, label double")
    data = data.select(array_to_vector("x").alias("features"), "label").persist()
    try:
        if data.select("label").distinct().count() < 2:
            return None
        return Trees.of(GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.4, seed=5).fit(data))
    finally:
        data.unpersist()


def extract(pages: DataFrame, model: Trees | None, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Per page: id, url, text, n_chars (code points)."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers
    schema = T.StructType([pages.schema[id_col], pages.schema[url_col], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                parsed = [Page(s or "") for s in part.column(2).to_pylist()]
                if trees is None:
                    odds = [np.where(p.marked() == 0, -1.0, 1.0) for p in parsed]
                else:
                    odds = np.split(trees.odds(np.concatenate([p.features() for p in parsed])),
                                    np.cumsum([len(p.tag) for p in parsed])[:-1])
                texts = [p.text(p.decode(o)) for p, o in zip(parsed, odds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return ready(pages).select(id_col, url_col, F.col(html_col).cast("string")).mapInArrow(run, schema)
