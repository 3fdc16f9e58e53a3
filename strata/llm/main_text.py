"""Main text of web pages by a minimum cut.

A page is read into blocks (runs of text between block-level tags) and the elements
around them.  Each block gets a log-odds of being main text: what its mark-up says
(element names, roles and class words, as stated weights) plus a logistic model of
its shape (length, links, punctuation, kind of element), which is fitted here on the
blocks whose mark-up is beyond doubt.  Labels are not chosen block by block:
the log-odds become capacities to the two terminals, neighbouring blocks and blocks
under one element are joined by smoothness edges, and the cheapest cut of that graph
parts main text from boilerplate.  So a two-word paragraph between long ones stays
and a lone long line among links goes.

The graph has an edge to the next block and one to the enclosing element, so its size
is linear in the page.  :func:`min_cut` first fixes every node whose own capacity
outweighs all its edges (it lies on that side of some minimum cut), which settles
nearly all, and runs augmenting flows on what is left.

Scripts, styles, templates, forms' controls and comments never give blocks.  Null or
blank html gives empty text; an unclosed or cut-off tag ends with the page.  Repeated
rows each give their row, extra columns are ignored, an empty table gives none.
"""

from __future__ import annotations

import html as _html
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: About so many pages are read to fit the shape model.
TRAIN_PAGES = 4000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Element names of HTML, and words that pages name their parts by.
_RAW = frozenset("script style template noscript textarea title svg math iframe object select button head".split())
_BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre
    section summary table tbody td tfoot th thead tr ul caption""".split())
_VOID = frozenset("hr br img input meta link area base col embed param source track wbr".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
           "tr": {"tr", "td", "th"}}
_STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"table", "tr"}, "th": {"table", "tr"},
          "tr": {"table"}}
_HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
_OUT_TAGS = frozenset("nav aside footer header form menu dialog".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu".split())
_OUT_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner
    nav navbar navigation menu breadcrumb breadcrumbs masthead header footer sidebar aside rail widget related
    recommended share sharing social cookie cookies consent notice notices notification alert newsletter subscribe
    subscription signup login comment comments reply replies discussion respond form search popup modal overlay
    pagination pager toolbar""".split())
_FRAME_WORDS = frozenset("no with has layout wrapper wrap container page body site".split())
_IN_WORDS = frozenset("article content main post entry story".split())
OUT_OF_DOUBT, ARTICLE, NAMED, OUTSIDE = -8.0, 4.0, 1.5, -3.0
SHAPE_LIMIT = 3.0
NEXT_BLOCK, SAME_ELEMENT = 1.2, 0.6
SCALE = 1000

_MARKS = re.compile(r"[©|·•»«›→]")


class Page:
    """Blocks of a page: ``texts``, ``shape`` rows, ``evidence`` of the mark-up, and
    ``parent`` element of each; ``up`` is the parent of each element."""

    __slots__ = ("texts", "shape", "evidence", "parent", "up", "depth")

    def __init__(self, source: str):
        self.texts: list[str] = []
        self.shape: list[tuple[float, ...]] = []
        self.parent: list[int] = []
        self.up, self.depth = [-1], [0]
        out, inside = [0.0], [0.0]        # strongest evidence on the way down to an element
        soft = [False]                    # out by a class word only
        stack: list[tuple[str, int]] = [("", 0)]
        opened: dict[str, int] = {}       # how often a tag stands on the stack
        pieces: list[str] = []
        linked = 0
        in_link = has_article = False
        at, n = 0, len(source)

        def flush():
            nonlocal linked
            if pieces:
                text = " ".join(_html.unescape("".join(pieces)).split())
                pieces.clear()
                if text:
                    tag = stack[-1][0]
                    words = text.count(" ") + 1
                    self.texts.append(text)
                    self.parent.append(stack[-1][1])
                    self.shape.append((
                        1.0, np.log1p(words), np.log1p(words) ** 2 / 4, min(1.0, linked / len(text)),
                        float(text[-1] in ".!?…\"”»)"), min(1.0, 8 * text.count(",") / words),
                        float(tag == "p"), float(tag in _HEADS), float(tag in ("li", "td", "th", "dt", "dd")),
                        float(_MARKS.search(text) is not None)))
            linked = 0

        while at < n:
            cut = source.find("<", at)
            if cut < 0:
                cut = n
            m = _TOKEN.match(source, cut) if cut < n else None
            stop = cut if m or cut == n else cut + 1   # a bare '<' is text
            if stop > at:
                chunk = source[at:stop]
                pieces.append(chunk)
                if in_link:
                    linked += len(chunk)
            if m is None:
                at = stop
                continue
            at = m.end()
            tag = m.group(2)
            if tag is None:
                continue
            tag = tag.lower()
            if tag in _RAW:
                if not m.group(1):
                    end = _end_of(tag).search(source, at)
                    at = end.end() if end else n
                    pieces.append(" ")
                continue
            if tag == "a":
                in_link = not m.group(1)
                continue
            if tag not in _BLOCK:
                if tag in ("br", "img", "input", "wbr"):
                    pieces.append(" " if tag != "wbr" else "")
                continue
            flush()
            if m.group(1):
                in_link = False
                while opened.get(tag):
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == tag:
                        break
                continue
            if stack[-1][0] == "p" or (stack[-1][0] in _HEADS and tag in _HEADS):
                opened[stack.pop()[0]] -= 1    # a block-level tag ends an open paragraph
            closes = _CLOSES.get(tag)
            if closes and any(opened.get(c) for c in closes):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in closes:
                        for last, _ in stack[k:]:
                            opened[last] -= 1
                        del stack[k:]
                        break
                    if stack[k][0] in _STOPS[tag]:
                        break
            if tag in _VOID:
                continue
            above = stack[-1][1]
            sure, by_word, good = _say(tag, m.group(3), inside[above] >= ARTICLE)
            if tag in ("article", "main"):
                has_article = True
                for _, e in stack:         # a part that holds the article is not boilerplate by its name
                    if soft[e]:
                        out[e], soft[e] = 0.0, False
            e = len(self.up)
            self.up.append(above)
            self.depth.append(self.depth[above] + 1)
            out.append(min(out[above], OUT_OF_DOUBT if sure or by_word else 0.0))
            soft.append(bool(by_word and not sure))
            inside.append(max(inside[above], good))
            stack.append((tag, e))
            opened[tag] = opened.get(tag, 0) + 1
        flush()
        rest = OUTSIDE if has_article else 0.0
        self.evidence = [out[e] if out[e] <= OUT_OF_DOUBT else
                         inside[e] + (rest if inside[e] < ARTICLE else 0.0) for e in self.parent]


_ENDS: dict[str, re.Pattern] = {}


def _end_of(tag: str) -> re.Pattern:
    if tag not in _ENDS:
        _ENDS[tag] = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)"
                                + (r"|(?=<body[\s>])" if tag == "head" else ""), re.I)
    return _ENDS[tag]


def _say(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool, float]:
    """What an element says of its text: (boilerplate by its kind, by a word of its
    class or id, main text)."""
    sure = tag in _OUT_TAGS and not (in_article and tag == "header")
    good = ARTICLE if tag in ("article", "main") else 0.0
    by_word = False
    if attrs and "=" in attrs and tag not in ("html", "body"):
        for name, a, b, c in _ATTR.findall(attrs):
            value = a or b or c
            if name.lower() == "role":
                role = value.strip().lower()
                sure = sure or role in _OUT_ROLES
                good = max(good, ARTICLE if role in ("main", "article") else 0.0)
                continue
            for word in value.split():
                parts = [w.lower() for w in _PIECE.findall(word)]
                if len(parts) > 1 and not _FRAME_WORDS.isdisjoint(parts):
                    continue
                hits = _OUT_WORDS.intersection(parts)
                if in_article:
                    hits = hits - {"header"}
                by_word = by_word or bool(hits)
                if not hits and not _IN_WORDS.isdisjoint(parts):
                    good = max(good, NAMED)
    return sure, by_word and tag not in ("article", "main"), good


def min_cut(gain: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels minimising the sum of ``gain`` lost (a positive one if labelled False,
    a negative one if labelled True) and of the weights of edges between labels."""
    n = len(gain)
    near: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    pull = [0] * n
    for a, b, w in edges:
        if w > 0 and a != b:
            near[a].append((b, w))
            near[b].append((a, w))
            pull[a] += w
            pull[b] += w
    gain = list(gain)
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:                          # a node that outweighs its edges is settled
        v = queue.popleft()
        if label[v] is not None or (abs(gain[v]) < pull[v] or (gain[v] == 0 and pull[v])):
            continue
        label[v] = gain[v] > 0
        for u, w in near[v]:
            if label[u] is None:
                gain[u] += w if label[v] else -w
                pull[u] -= w
                queue.append(u)
    rest = [v for v in range(n) if label[v] is None]
    if rest:
        _flow(rest, gain, near, label)
    return [bool(x) for x in label]


def _flow(rest: list[int], gain: list[int], near, label: list) -> None:
    """Maximum flow over the unsettled nodes (level graphs, then blocking paths)."""
    at = {v: k for k, v in enumerate(rest)}
    s, t = len(rest), len(rest) + 1
    adj: list[list[int]] = [[] for _ in range(t + 1)]
    head: list[int] = []
    cap: list[int] = []

    def join(a: int, b: int, there: int, back: int) -> None:
        adj[a].append(len(head)); head.append(b); cap.append(there)   # noqa: E702
        adj[b].append(len(head)); head.append(a); cap.append(back)    # noqa: E702

    for v in rest:
        if gain[v] > 0:
            join(s, at[v], gain[v], 0)
        elif gain[v] < 0:
            join(at[v], t, -gain[v], 0)
        for u, w in near[v]:
            if v < u and u in at:
                join(at[v], at[u], w, w)
    while True:
        level = [-1] * (t + 1)
        level[s] = 0
        queue = deque([s])
        while queue:
            v = queue.popleft()
            for e in adj[v]:
                if cap[e] > 0 and level[head[e]] < 0:
                    level[head[e]] = level[v] + 1
                    queue.append(head[e])
        if level[t] < 0:
            break
        turn = [0] * (t + 1)
        path: list[int] = []
        v = s
        while True:
            if v == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                k = next(i for i, e in enumerate(path) if cap[e] == 0)
                v = head[path[k] ^ 1]
                del path[k:]
                continue
            while turn[v] < len(adj[v]):
                e = adj[v][turn[v]]
                if cap[e] > 0 and level[head[e]] == level[v] + 1:
                    break
                turn[v] += 1
            if turn[v] < len(adj[v]):
                path.append(adj[v][turn[v]])
                v = head[path[-1]]
            elif path:
                v = head[path.pop() ^ 1]
                turn[v] += 1
            else:
                break
    for v in rest:                        # the side that still can be reached from the source
        label[v] = level[at[v]] >= 0


def page_graph(page: Page, weights: np.ndarray) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Terminal capacities (blocks first, then elements with several children) and edges."""
    n = len(page.texts)
    logit = np.clip(np.array(page.shape) @ weights, -SHAPE_LIMIT, SHAPE_LIMIT) + np.array(page.evidence)
    gain = np.rint(logit * SCALE).astype(int).tolist()
    # elements with one child only pass their parent on
    kids = [0] * len(page.up)
    for e in page.parent:
        kids[e] += 1
    for e in range(len(page.up) - 1, 0, -1):
        if kids[e]:
            kids[page.up[e]] += 1
    joint = [0] * len(page.up)            # nearest element with several children, itself included
    for e in range(len(page.up)):
        joint[e] = e if e == 0 or kids[e] > 1 else joint[page.up[e]]
    node: dict[int, int] = {}
    edges: list[tuple[int, int, int]] = []
    for b, e in enumerate(page.parent):
        around = joint[e]
        below = b
        while around not in node:
            node[around] = n + len(node)
            gain.append(0)
            edges.append((below, node[around], int(SAME_ELEMENT * SCALE / (1 if below == b else 2))))
            if around == 0:
                break
            below, around = node[around], joint[page.up[around]]
        else:
            edges.append((below, node[around], int(SAME_ELEMENT * SCALE / (1 if below == b else 2))))
        if b:
            edges.append((b - 1, b, int(NEXT_BLOCK * SCALE / _distance(page, page.parent[b - 1], e))))
    return gain, edges


def _distance(page: Page, a: int, b: int) -> int:
    """Steps between two elements in the tree, plus one."""
    steps = 1
    while a != b:
        if page.depth[a] < page.depth[b]:
            a, b = b, a
        a = page.up[a]
        steps += 1
    return steps


def main_text(source: str, weights: np.ndarray) -> str:
    page = Page(source)
    if not page.texts:
        return ""
    labels = min_cut(*page_graph(page, weights))
    return "\n".join(t for t, keep in zip(page.texts, labels) if keep)


#: What the shape model starts from and is held near (alone where the pages lack one of
#: the two kinds): longer text with fewer links and whole sentences is main text.  Pages
#: of one make, whose article differs from the rest in its element names alone, would
#: otherwise teach it nothing about text.
DEFAULT_SHAPE = np.array([-2.5, 1.2, 0.0, -3.0, 1.0, 0.5, 0.5, 0.0, -0.5, -1.5])


def fit_shape(x: np.ndarray, y: np.ndarray, hold: float = 0.1, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps, with a Gaussian prior at the starting
    weights of strength ``hold`` times the number of blocks; both classes weigh the same."""
    n1 = int(y.sum())
    if n1 == 0 or n1 == len(y):
        return DEFAULT_SHAPE
    weight = np.where(y == 1, 0.5 / n1, 0.5 / (len(y) - n1)) * len(y)
    w = DEFAULT_SHAPE.copy()
    pen = hold * len(y)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + pen * (w - DEFAULT_SHAPE)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + pen * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def shape_model(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> np.ndarray:
    """Fit the shape model on about ``train_pages`` pages, drawn by a hash of the
    html: their blocks inside an article count as main text, those in navigation,
    adverts and the like as boilerplate, all others are left out.  Only sums of equal
    shapes travel (shapes are rounded), at most one row per block of the sample."""
    total = pages.count()
    share = min(1.0, train_pages / max(1, total))
    drawn = pages.where(F.pmod(F.xxhash64("html", "page_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    width = len(DEFAULT_SHAPE)

    def work(batches):
        for batch in batches:
            found: dict[tuple, int] = {}
            for text in batch.column(0).to_pylist():
                page = Page(text or "")
                for row, e in zip(page.shape, page.evidence):
                    if e >= ARTICLE or e <= OUT_OF_DOUBT:
                        key = (int(e > 0), *(round(float(v), 2) for v in row))
                        found[key] = found.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.int32()),
                 pa.array([list(k[1:]) for k in found], pa.list_(pa.float64())),
                 pa.array(list(found.values()), pa.int64())], names=["y", "x", "n"])

    seen = (drawn.select("html").mapInArrow(work, "y int, x array<double>, n long")
            .groupBy("y", "x").agg(F.sum("n").alias("n")).toArrow())
    if len(seen) == 0:
        return DEFAULT_SHAPE
    x = np.array(seen["x"].combine_chunks().flatten()).reshape(-1, width)
    n = seen["n"].to_numpy()
    y = seen["y"].to_numpy()
    order = np.lexsort(np.column_stack([x, y]).T)   # the same sums whatever order the rows came in
    times = np.minimum(n, 50)[order]                # a very common block is no more than 50
    return fit_shape(np.repeat(x[order], times, axis=0), np.repeat(y[order], times))


def extract(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every page.  One pass over
    the pages after the fit; no shuffle."""
    html = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    weights = shape_model(html, train_pages)

    def work(batches):
        for batch in batches:
            texts = [main_text(t, weights) if t else "" for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return html.mapInArrow(work, "page_id long, url string, text string, n_chars long")
