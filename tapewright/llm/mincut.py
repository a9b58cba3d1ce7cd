"""Main text of a web page by a minimum cut between content and boilerplate.

A page's text blocks (what stands between block-level tags) are the nodes of a network. Terminal
capacities come from classifier costs: a logistic model over the shape of a block (length, links,
sentence marks, kind of element), plus fixed log-odds for what the elements around it are named.
Neighbours in page order, and neighbours among the blocks of one parent, share smoothness edges that
are stronger the closer they are in the element tree. Maximum flow separates the two sides; blocks
on the content side, in page order, are the text.

The shape model is trained on the blocks of a bounded sample of pages (``train_pages``, drawn by a
hash of the id) in which element names speak for themselves, as content or as boilerplate.

Blocks whose terminal capacity is no less than all their edges together are on their own side in some
minimum cut; they are settled first, repeatedly, and only the rest is left to augmenting paths.

Defined results: a null, empty or textless page has an empty text; scripts, styles, templates,
comments and the head are no text; an unfinished tag at the end is no text; repeated rows are
handled one by one; with no page to learn from only names count.
"""

from __future__ import annotations

import html
import re
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.common import column, in_batches, ship, texts_of

# Elements of the HTML standard by what they mean for text.
RAW = {"script", "style", "template", "iframe", "head", "title"}
INLINE = set(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark math mfrac mi mn mo mrow msqrt"
    " msub msup mtext q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SELF_CLOSING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Parts of running text: within an article their names tell style, not boilerplate.
RUNNING = {"p", "li", "blockquote", "pre", "figcaption", "dd", "dt", "td", "th", *HEADINGS}
# Log-odds of being content that names of elements and of classes and ids carry.
TAG_ODDS = {
    "article": 5.0, "main": 4.0, "nav": -8.0, "footer": -8.0, "aside": -8.0, "form": -8.0, "menu": -8.0,
    "button": -8.0, "select": -8.0, "textarea": -8.0, "dialog": -8.0, "header": -8.0,
}
CONTENT_WORDS = set("article content entry main post story".split())
NOISE_WORDS = set(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent"
    " cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice"
    " pager pagination popup privacy promo promoted related replies respond search share sharing sidebar"
    " social sponsor sponsored subscribe teaser toolbar widget".split()
)
CONTENT_ODDS, NOISE_ODDS = 2.5, -8.0

_PIECE = re.compile(
    r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|<[a-zA-Z/!?][^>]*$",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"\bhidden\b(?!-)|display\s*:\s*none", re.I)
FEATURES = 9


@dataclass
class Block:
    text: str
    odds: float  # of the names around it
    shape: list[float]
    path: tuple[int, ...]  # element numbers from the root to the parent


@dataclass
class _Element:
    tag: str
    number: int
    odds: float
    inside: bool  # within an article or main element
    link: bool


@dataclass
class _Reader:
    stack: list[_Element] = field(default_factory=lambda: [_Element("", 0, 0.0, False, False)])
    made: int = 0
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    blocks: list[Block] = field(default_factory=list)

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            if self.stack[-1].link:
                self.linked += len(raw)

    def flush(self) -> None:
        if not self.parts:
            return
        raw = "".join(self.parts)
        text = " ".join(html.unescape(raw).split())
        if text:
            own = next((e.tag for e in reversed(self.stack) if e.tag not in INLINE), "")
            self.blocks.append(
                Block(text, self.stack[-1].odds, _shape(text, self.linked / len(raw), own),
                      tuple(e.number for e in self.stack if e.tag not in INLINE))
            )
        self.parts.clear()
        self.linked = 0

    def open(self, tag: str, attributes: str) -> None:
        if tag in SELF_CLOSING:
            for at in range(len(self.stack) - 1, 0, -1):
                if self.stack[at].tag == tag:
                    self.flush()
                    del self.stack[at:]
                    break
                if self.stack[at].tag not in INLINE and self.stack[at].tag not in SELF_CLOSING:
                    break
        top = self.stack[-1]
        odds = TAG_ODDS.get(tag, 0.0)
        if tag == "header" and top.inside:
            odds = 0.0  # an article's own head
        if attributes:
            words = {w for m in _NAMES.findall(attributes) for w in _WORD.findall(m.lower())}
            plain = tag in INLINE or top.inside and (tag in RUNNING or tag == "header")
            if words & NOISE_WORDS and not (plain or tag in ("html", "body")):
                odds += NOISE_ODDS
            elif words & CONTENT_WORDS:
                odds += CONTENT_ODDS
            if _HIDDEN.search(attributes):
                odds += NOISE_ODDS
        if tag not in INLINE or odds:
            self.flush()
        if tag in VOID:
            return
        self.made += 1
        inside = top.inside or tag in ("article", "main")
        self.stack.append(_Element(tag, self.made, top.odds + odds, inside, top.link or tag == "a"))

    def close(self, tag: str) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == tag:
                if tag not in INLINE or self.stack[at].odds != self.stack[at - 1].odds:
                    self.flush()
                del self.stack[at:]
                return
            if tag in INLINE and self.stack[at].tag not in INLINE:
                return
        if tag not in INLINE:
            self.flush()


def _shape(text: str, linked: float, tag: str) -> list[float]:
    words = text.count(" ") + 1
    return [
        1.0, min(np.log2(1 + words), 8.0) / 4, linked, float(text[-1] in ".!?…\"'”"),
        min(text.count(",") + text.count(". "), 10) / 5, float(tag in HEADINGS), float(tag == "p"),
        float(tag in ("li", "td", "th", "dt", "dd")), float(words < 4),
    ]


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    reader, at, n = _Reader(), 0, len(page)
    while at < n:
        m = _PIECE.search(page, at)
        if not m:
            reader.text(page[at:])
            break
        reader.text(page[at : m.start()])
        at = m.end()
        shut, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if shut:
            reader.close(tag)
        elif tag in RAW:
            reader.flush()
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                if tag == "head" and not end:
                    end = re.compile(r"(?=<body\b)", re.I).search(page, at)
                at = end.end() if end else n
        else:
            reader.open(tag, attributes)
    reader.flush()
    return reader.blocks


def network(blocks: list[Block], adjacent: float, sibling: float) -> dict[tuple[int, int], float]:
    """Smoothness edges: capacity falls with the distance in the element tree."""
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            common = 0
            for x, y in zip(blocks[i - 1].path, b.path, strict=False):
                if x != y:
                    break
                common += 1
            far = len(blocks[i - 1].path) + len(b.path) - 2 * common
            edges[i - 1, i] = adjacent / (1 + far)
        parent = b.path[-2] if len(b.path) > 1 else b.path[-1]
        if parent in last:
            pair = (last[parent], i)
            edges[pair] = edges.get(pair, 0.0) + sibling
        last[parent] = i
    return edges


def minimum_cut(odds: np.ndarray, edges: dict[tuple[int, int], float]) -> list[bool]:
    """The source side: node i is tied to the source by odds[i] if positive, else to the sink."""
    n = len(odds)
    weight = [float(o) for o in odds]
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (a, b), c in edges.items():
        near[a][b] = near[b][a] = near[a].get(b, 0.0) + c
    side: list[bool | None] = [None] * n
    load = [sum(x.values()) for x in near]
    queue = deque(i for i in range(n) if abs(weight[i]) >= load[i])
    while queue:
        i = queue.popleft()
        if side[i] is not None:
            continue
        side[i] = weight[i] > 0
        for j, c in near[i].items():
            if side[j] is None:
                weight[j] += c if side[i] else -c
                load[j] -= c
                if abs(weight[j]) >= load[j] - 1e-12:
                    queue.append(j)
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        reached = _max_flow(rest, weight, near)
        for i in rest:
            side[i] = i in reached
    return [bool(s) for s in side]


def _max_flow(nodes: list[int], weight: list[float], near: list[dict[int, float]]) -> set[int]:
    """Dinic's algorithm; the nodes that the source still reaches when no path is left."""
    s, t = -1, -2
    inside = set(nodes)
    left: dict[int, dict[int, float]] = {s: {}, t: {}}
    for i in nodes:
        left[i] = {j: c for j, c in near[i].items() if j in inside}
    for i in nodes:
        if weight[i] > 0:
            left[s][i], left[i][s] = weight[i], 0.0
        elif weight[i] < 0:
            left[i][t], left[t][i] = -weight[i], 0.0
    while True:
        level = {s: 0}
        queue = deque([s])
        while queue:
            i = queue.popleft()
            for j, c in left[i].items():
                if c > 1e-9 and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if t not in level:
            return set(level)
        todo = {i: iter(list(left[i])) for i in level}
        path = [s]
        while path:
            i = path[-1]
            if i == t:
                flow = min(left[a][b] for a, b in zip(path, path[1:], strict=False))
                for a, b in zip(path, path[1:], strict=False):
                    left[a][b] -= flow
                    left[b][a] += flow
                cut = next(k for k, (a, b) in enumerate(zip(path, path[1:], strict=False)) if left[a][b] <= 1e-9)
                del path[cut + 1 :]
                continue
            for j in todo[i]:
                if left[i][j] > 1e-9 and level.get(j, -1) == level[i] + 1:
                    path.append(j)
                    # The edge may be wanted again by another path.
                    todo[i] = _again(j, todo[i])
                    break
            else:
                level[i] = -1
                path.pop()


def _again(first, rest):
    yield first
    yield from rest


def train(blocks: list[tuple[float, list[float], int]], steps: int = 400, rate: float = 0.5) -> np.ndarray:
    """Logistic weights from (odds of the names, shape, how often) of blocks whose names are clear."""
    clear = [(o > 0, s, n) for o, s, n in blocks if abs(o) >= 2]
    if len({c[0] for c in clear}) < 2:
        return np.zeros(FEATURES)
    y, x, n = (np.array(c, float) for c in zip(*clear, strict=True))
    weight = n * np.where(y > 0, 0.5 / (n * y).sum(), 0.5 / (n * (1 - y)).sum())
    w = np.zeros(FEATURES)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= rate * (x.T @ (weight * (p - y)) + 1e-3 * w)
    return w


def main_text(page: str, weights: np.ndarray, adjacent: float = 0.6, sibling: float = 0.3) -> str:
    """The content blocks of a page, joined."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    shape = np.clip(np.array([b.shape for b in blocks]) @ weights, -3.0, 3.0)
    odds = np.array([b.odds for b in blocks]) + shape
    side = minimum_cut(odds, network(blocks, adjacent, sibling))
    return " ".join(b.text for b, content in zip(blocks, side, strict=True) if content)


def fit(pages: DataFrame, train_pages: int = 1_000, page: str = "html", page_id: str = "page_id") -> np.ndarray:
    """Shape weights from the clear blocks of about ``train_pages`` pages drawn by a hash of the id."""
    rows = pages.select(column(pages, page_id).alias("page_id"), column(pages, page).alias("text"))
    rows = rows.where(F.col("page_id").isNotNull() & F.col("text").isNotNull())
    n = rows.count()
    if not n:
        return np.zeros(FEATURES)
    draw = F.pmod(F.xxhash64(F.col("page_id").cast("string"), F.lit("page")), F.lit(1 << 30))

    def clear(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(b.odds, b.shape) for t in texts_of(batch) for b in blocks_of(t)]
        return pa.record_batch({"odds": pa.array([f[0] for f in found], pa.float64()),
                                "shape": pa.array([f[1] for f in found], pa.list_(pa.float64()))})

    drawn = in_batches(rows.where(draw < min(1 << 30, train_pages * (1 << 30) // n)), clear, "odds double, shape array<double>")
    # Equal blocks are counted together, so the driver gets few rows and sums in a fixed order.
    got = drawn.groupBy("odds", "shape").count().orderBy("odds", "shape").collect()
    return train([(r["odds"], r["shape"], r["count"]) for r in got])


def extract(
    pages: DataFrame, train_pages: int = 1_000, page: str = "html", page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    weights = fit(pages, train_pages, page, page_id)
    rows = pages.select(
        column(pages, page_id).alias("page_id"), column(pages, url).alias("url"), column(pages, page).alias("text")
    )
    kind = rows.schema["page_id"].dataType.simpleString()

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(t, weights) for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
             pa.array([len(t) for t in found], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    return in_batches(rows, read, f"page_id {kind}, url string, text string, n_chars long")


ship(__name__)
