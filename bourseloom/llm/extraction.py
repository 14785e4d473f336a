"""Main text of HTML pages by minimum-cut labelling of their blocks.

A page is read into blocks: runs of text between block tags, character references decoded, white
space made single. Every block has a node in a flow network. Its terminal capacities are the
costs of calling it content or boilerplate: a classifier's log odds plus landmarks (semantic tags
and words of class, id and role around it). Edges between neighbours in page order, and to the
block before it under the same parent, cost more the nearer the two are in the DOM. The maximum
flow's cut is the cheapest labelling; content blocks are joined in page order.

A boilerplate mark holds for all below it, but not for a wrapper of half of the page's text with the
content landmark in it (or of nine tenths, where the page has no such landmark), and not for a
``main``, an ``article`` in a form, or the page's only ``article``.

The classifier is a linear discriminant over a block's shape (words, links, marks, place), fitted
on all pages from sums per task, where landmarks give the labels. Landmarks outweigh it; it
decides where a page has none.

Defined cases: a null or empty page has an empty text; broken or unclosed markup is read as far as
it goes: a hidden element that is never closed ends at the first block tag inside it, or with the
element around it, and a head ends at the first block; a text without any markup is one block; rows are independent, so repeated rows give
repeated results; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tags and attribute words.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt
 fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p
 pre section summary table tbody td tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("""audio button canvas iframe noscript object script select style svg template
 textarea title video""".split())
BOILER_TAGS = frozenset("aside dialog footer form menu nav".split())
CONTENT_TAGS = frozenset(["article", "main"])
BOILER_WORDS = frozenset("""ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment
 comments complementary consent contentinfo cookie cookies disqus footer login menu modal nav navbar
 navigation newsletter notice popup promo promoted related replies respond search share sharing sidebar
 signup social sponsor sponsored subscribe toolbar widget""".split())
CONTENT_WORDS = frozenset("article content entry main post story".split())
#: Only outside an article these mark boilerplate.
HEAD_MARKS = frozenset(["header", "masthead"])

LANDMARK, SHAPE_LIMIT, SMOOTH = 8.0, 3.0, 1.0
#: Least share of the text in a wrapper that holds the content landmark, and where there is none.
WRAPPER, WHOLE = 0.5, 0.9
_SPLIT = re.compile(r"[^a-z]+")
_SPACE = re.compile(r"\s+")
SHAPES = 7


class Block:
    __slots__ = ("words", "text", "tag", "path", "mark", "linked")

    def __init__(self, text: str, tag: str, path: tuple[int, ...], mark: int, linked: int) -> None:
        self.text, self.tag, self.path, self.mark, self.linked = text, tag, path, mark, linked
        self.words = text.count(" ") + 1


class TagReader(HTMLParser):
    """Events (kind, tag or text, attributes) in page order: 1 start, 0 start and end, -1 end, 2 text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[tuple[int, str, list]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.events.append((1, tag, attrs))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.events.append((0, tag, attrs))

    def handle_endtag(self, tag: str) -> None:
        self.events.append((-1, tag, []))

    def handle_data(self, data: str) -> None:
        self.events.append((2, data, []))


def hidden_ends(events: list[tuple[int, str, list]]) -> dict[int, int]:
    """For the start of each hidden element that is closed: the place of its own end tag."""
    open_, count, ends = [], {}, {}
    for at, (kind, tag, _) in enumerate(events):
        if kind not in (1, -1) or tag in VOID_TAGS or (tag not in BLOCK_TAGS and tag not in HIDDEN_TAGS):
            continue
        if kind == 1:
            open_.append((tag, at))
            count[tag] = count.get(tag, 0) + 1
        elif count.get(tag):
            while True:
                last, start = open_.pop()
                count[last] -= 1
                if last == tag:
                    break
            if tag in HIDDEN_TAGS:
                ends[start] = at
    return ends


class BlockReader:
    """Blocks with the DOM path above them and a landmark: 1 content, -1 boilerplate, 0 none."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.open: list[tuple[str, int]] = []
        #: Parent, tag and attribute words of each element on a path; 0 is the page.
        self.elements: list[tuple[int, str, set[str]]] = [(0, "", set())]
        self.links = self.linked = 0
        self.parts: list[str] = []

    def read(self, events: list[tuple[int, str, list]]) -> None:
        ends, until, unclosed = hidden_ends(events), -1, -1
        for at, (kind, tag, attrs) in enumerate(events):
            hidden = at <= until or unclosed >= 0
            if kind == 2:
                if not hidden:
                    self.parts.append(tag)
                    if self.links:
                        self.linked += len(tag)
            elif tag == "a":
                self.links = max(0, self.links + kind)
            elif at <= until:
                continue
            elif tag in HIDDEN_TAGS:
                if kind == 1 and at in ends:
                    until = ends[at]
                elif kind == 1 and unclosed < 0:
                    unclosed = len(self.open)
            elif tag == "br" and kind >= 0:
                if not hidden:
                    self.parts.append(" ")
            elif tag in BLOCK_TAGS:
                self.close_block()
                if kind == 1:
                    unclosed = -1
                    self.start(tag, attrs)
                elif kind == -1:
                    self.end(tag)
                    if len(self.open) < unclosed:
                        unclosed = -1
        self.close_block()
        self.mark()

    def close_block(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            tag = self.open[-1][0] if self.open else ""
            self.blocks.append(Block(text, tag, tuple(n for _, n in self.open), 0, self.linked))
        self.parts, self.linked = [], 0

    def start(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open and self.open[-1][0] == "head":
            self.open.pop()
        if tag == "p" or (tag == "li" and self.open and self.open[-1][0] == "li"):
            if self.open and self.open[-1][0] in ("p", "li") and (tag == self.open[-1][0]):
                self.open.pop()
        elif self.open and self.open[-1][0] == "p":
            self.open.pop()
        if tag not in VOID_TAGS:
            words: set[str] = set()
            for name, value in attrs:
                if name in ("class", "id", "role") and value:
                    words.update(_SPLIT.split(value.lower()))
            self.elements.append((self.open[-1][1] if self.open else 0, tag, words))
            self.open.append((tag, len(self.elements) - 1))

    def end(self, tag: str) -> None:
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is not None:
            del self.open[at:]

    def mark(self) -> None:
        """The landmarks, from the elements with the text and the content landmarks inside them."""
        n = len(self.elements)
        size, content = [0] * n, [False] * n
        for b in self.blocks:
            size[b.path[-1] if b.path else 0] += len(b.text)
        boiler = [tag in BOILER_TAGS or bool(words & BOILER_WORDS) for _, tag, words in self.elements]
        for i in range(n - 1, 0, -1):
            parent, tag, words = self.elements[i]
            content[i] |= not boiler[i] and (tag in CONTENT_TAGS or bool(words & CONTENT_WORDS))
            size[parent] += size[i]
            content[parent] |= content[i]
        articles = sum(tag == "article" for _, tag, _ in self.elements)
        marks, by_form = [0] * n, [False] * n
        for i in range(1, n):
            parent, tag, words = self.elements[i]
            above = marks[parent]
            least = WRAPPER if content[i] else 2.0 if content[0] else WHOLE
            wrapper = size[i] >= least * size[0] and (tag == "form" or tag not in BOILER_TAGS)
            own = boiler[i] or (above == 0 and (tag in HEAD_MARKS or bool(words & HEAD_MARKS)))
            lifted = not boiler[i] and (tag == "main" or (tag == "article" and (articles == 1 or by_form[parent])))
            if above < 0 and not lifted:
                marks[i], by_form[i] = above, by_form[parent] and not boiler[i]
            elif own and not wrapper and not lifted:
                marks[i], by_form[i] = -1, tag == "form" and not words & BOILER_WORDS
            elif tag in CONTENT_TAGS or (words & CONTENT_WORDS and not own):
                marks[i] = 1
            else:
                marks[i] = above
        for b in self.blocks:
            b.mark = marks[b.path[-1]] if b.path else 0


def read_blocks(html: str | None) -> list[Block]:
    tags, reader = TagReader(), BlockReader()
    tags.feed(html or "")
    tags.close()
    reader.read(tags.events)
    return reader.blocks


def shapes(blocks: list[Block]) -> np.ndarray:
    """One row of shape features per block; none of them is a landmark."""
    n = len(blocks)
    return np.array([[
        np.log1p(b.words), min(1.0, b.linked / len(b.text)),
        sum(b.text.count(c) for c in ".,;:!?") / b.words, len(b.text) / b.words,
        float(b.tag == "p"), float(b.tag in ("li", "td", "th", "dt", "dd")), i / n,
    ] for i, b in enumerate(blocks)]).reshape(n, SHAPES)


def fit(pages: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear discriminant, from sums over all pages."""

    def sums(batches):
        total = np.zeros((2, 1 + SHAPES + SHAPES * SHAPES))
        for batch in batches:
            for html in batch.column(0).to_pylist():
                blocks = read_blocks(html)
                marks = np.array([b.mark for b in blocks])
                x = shapes(blocks)
                for k, mark in enumerate((-1, 1)):
                    own = x[marks == mark] if len(blocks) else x
                    total[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["side", "v"])

    parts = pages.select("html").mapInArrow(sums, "side int, v array<double>")
    folded = parts.select("side", F.posexplode("v")).groupBy("side", "pos").agg(F.sum("col").alias("v"))
    total = np.zeros((2, 1 + SHAPES + SHAPES * SHAPES))
    for r in folded.collect():
        total[r["side"], r["pos"]] = r["v"]
    counts = total[:, 0]
    if counts.min() < 1:
        return np.zeros(SHAPES), 0.0
    means = total[:, 1:1 + SHAPES] / counts[:, None]
    spread = sum(total[k, 1 + SHAPES:].reshape(SHAPES, SHAPES) - counts[k] * np.outer(means[k], means[k])
                 for k in (0, 1)) / counts.sum()
    weights = np.linalg.solve(spread + 1e-3 * np.eye(SHAPES), means[1] - means[0])
    return weights, float(-(means[0] + means[1]) @ weights / 2)


def _distance(a: Block, b: Block) -> int:
    shared = next((i for i, (x, y) in enumerate(zip(a.path, b.path, strict=False)) if x != y),
                  min(len(a.path), len(b.path)))
    return len(a.path) + len(b.path) - 2 * shared


def neighbours(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges (block, earlier block, capacity)."""
    edges, last_under = [], {}
    for i, b in enumerate(blocks):
        parent = b.path[:-1]
        near = {i - 1} if i else set()
        if parent in last_under:
            near.add(last_under[parent])
        edges.extend((i, j, SMOOTH / (1 + _distance(b, blocks[j]))) for j in near)
        last_under[parent] = i
    return edges


def minimum_cut(odds: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """True for the blocks on the content side of the cheapest cut.

    Positive odds are the capacity from the content terminal, negative ones that to the other.
    The flow is raised along shortest paths until none is left.
    """
    n = len(odds)
    room: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, c in edges:
        room[i][j] = room[i].get(j, 0.0) + c
        room[j][i] = room[j].get(i, 0.0) + c
    give, take = np.maximum(odds, 0.0), np.maximum(-odds, 0.0)
    while True:
        came = {i: -1 for i in range(n) if give[i] > 1e-9}
        line, goal = list(came), -1
        for i in line:
            if take[i] > 1e-9:
                goal = i
                break
            for j, c in room[i].items():
                if c > 1e-9 and j not in came:
                    came[j] = i
                    line.append(j)
        if goal < 0:
            side = np.zeros(n, bool)
            side[list(came)] = True
            return side
        path = [goal]
        while came[path[-1]] >= 0:
            path.append(came[path[-1]])
        flow = min([give[path[-1]], take[goal], *(room[b][a] for a, b in zip(path, path[1:], strict=False))])
        give[path[-1]] -= flow
        take[goal] -= flow
        for a, b in zip(path, path[1:], strict=False):
            room[b][a] -= flow
            room[a][b] += flow


def main_text(html: str | None, model: tuple[np.ndarray, float]) -> str:
    blocks = read_blocks(html)
    if not blocks:
        return ""
    odds = np.clip(shapes(blocks) @ model[0] + model[1], -SHAPE_LIMIT, SHAPE_LIMIT)
    odds = odds + LANDMARK * np.array([b.mark for b in blocks])
    content = minimum_cut(odds, neighbours(blocks))
    return "\n".join(b.text for b, c in zip(blocks, content, strict=True) if c)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    model = pages.sparkSession.sparkContext.broadcast(fit(pages))

    def run(batches):
        for batch in batches:
            texts = [main_text(h, model.value) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string")
