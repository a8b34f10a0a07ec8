"""Main text of web pages by a minimum cut between content and boilerplate.

A page is read into blocks, its runs of text between block-level tags. A linear classifier
over a block's tags, names, links and length, and over the names around it, gives its cost on
either side: the capacity from the content terminal or to the boilerplate terminal. Neighbours
on the page and blocks of one parent are tied by smoothness edges. The cut of least capacity
labels all blocks.
A block whose terminal capacity is no less than all its ties together keeps that side in a
minimum cut, so such blocks are settled first and the flow runs on the rest.
"""

from __future__ import annotations

import html
import re
import sys
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trunkline.llm import text as tx
from trunkline.llm.common import table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Tags by their part in a page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center col colgroup dd details dialog "
    "dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW_TAGS = frozenset(
    "script style noscript template textarea iframe svg math object canvas audio video noembed "
    "noframes xmp".split()
)
DROPPED_TAGS = frozenset(
    "nav footer header aside form menu button select option optgroup fieldset legend dialog "
    "label head title".split()
)
#: Of these, tags that may stand around a whole page, and no boilerplate in an article.
WRAPPER_TAGS = frozenset("form fieldset label header".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
#: Words of classes and ids that say what a part of a page is: parts that hold articles or
#: prose of others, parts that do so at the edge of a page, and parts of the layout.
FOREIGN_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense sponsored promo cookie cookies gdpr newsletter "
    "subscribe comment comments comentarios kommentare replies respond disqus share sharing".split()
)
EDGE_NAMES = frozenset("sidebar footer widget widgets popup modal overlay".split())
LAYOUT_NAMES = frozenset(
    "banner banners nav navbar menu menus breadcrumb breadcrumbs header masthead topbar toolbar "
    "pagination pager".split()
)
#: Words that are headings of prose as well.
WEAK_NAMES = frozenset(
    "advertising sponsor promotion navigation side foot consent notice notices alert subscription "
    "signup login register search reply discussion social follow related recommended trending "
    "popular copyright legal disclaimer privacy skip print".split()
)
#: Words that make a weak one a part of a page, and those that may stand beside any.
THINGS = frozenset("articles bar box buttons form icons items link links list media posts stories us".split())
BESIDE = THINGS | frozenset(
    "area block bottom container global inner item left line outer page primary "
    "right secondary section site slot top unit wrap wrapper".split()
)
CONTENT_NAMES = frozenset(
    "article content contents entry main post story text body prose".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BOILERPLATE = FOREIGN_NAMES | EDGE_NAMES | LAYOUT_NAMES | WEAK_NAMES
_WHOLE = _BOILERPLATE | BESIDE

#: Classifier weights, in units of cost.
BIAS, IN_CONTENT, PARAGRAPH, HEADING, SENTENCE, LONG, LINKS, WEAK, NAMED, DROPPED, HIDDEN = (
    -1.0, 3.0, 1.5, 0.5, 0.8, 1.5, -4.0, -3.0, -6.0, -12.0, -20.0,
)
#: What a page whose blocks all stay below the bias has added to each of them.
PLAIN = 1.0
#: Capacities of the ties: neighbours on the page, and neighbours among a parent's blocks.
NEAR, SIBLING = 0.5, 0.9

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^'\">]|\"[^\"]*+\"|'[^']*+')*+)>|"
    r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|</?[a-zA-Z][^<>]*+\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_NAME = re.compile(r"[a-z]+")
_VERSION = re.compile(r"\d+x\d+|(?<![a-z])v\d+(?![a-z\d])")


@dataclass
class Element:
    """``hidden``, ``foreign``, ``edge`` and ``wrapper`` are costs by what ends them.

    Nothing ends the first. ``main``, or an article with most of the page's text, ends the
    others, any article the last. On an element with most of the text the last two do not
    count. Text in links is left out here.
    """

    tag: str
    parent: int
    hidden: float = 0.0
    foreign: float = 0.0
    edge: float = 0.0
    wrapper: float = 0.0
    content: bool = False
    article: bool = False
    starts: str = ""

    @property
    def dropped(self) -> float:
        return min(self.hidden, self.foreign, self.edge, self.wrapper)


@dataclass
class Block:
    text: str
    parent: int
    cost: float
    edges: dict[int, float] = field(default_factory=dict)


def _tokens(value: str) -> list[list[str]]:
    """The words of each class name or id, camel case included, sizes and versions left out."""
    spaced = re.sub(r"([a-z])([A-Z])", r"\1-\2", value)
    return [_NAME.findall(_VERSION.sub("", t.lower())) for t in spaced.split()]


def _named(element: Element, value: str) -> None:
    """Costs and content of an element by one of its attributes of names.

    A name counts as a whole: one word of a longer name says nothing, but for those that
    stand beside parts of a page.
    """
    tokens = [set(t) for t in _tokens(value) if t]
    flat = set().union(*tokens)
    post = {"article"} in tokens or {"entry"} in tokens or {"post"} in tokens
    for words in tokens:
        if not words <= _WHOLE or post and not words & FOREIGN_NAMES:
            continue
        if element.article:
            words = words - {"header", "masthead"}
        if words & FOREIGN_NAMES:
            element.foreign = min(element.foreign, NAMED)
        elif words & EDGE_NAMES:
            element.edge = min(element.edge, NAMED)
        elif words & LAYOUT_NAMES or words & WEAK_NAMES and words & THINGS:
            element.wrapper = min(element.wrapper, NAMED)
        elif words & WEAK_NAMES:
            element.wrapper = min(element.wrapper, WEAK)
    if flat & CONTENT_NAMES and not element.dropped and (post or not flat & _BOILERPLATE):
        element.content = True


def _element(tag: str, attributes: str, parent: int, article: bool) -> Element:
    """An element with its own costs, those around it left out."""
    element = Element(tag, parent, article=article)
    if tag in DROPPED_TAGS:
        if tag not in WRAPPER_TAGS:
            element.foreign = DROPPED
        elif tag != "header" or not article:
            element.wrapper = DROPPED
    if tag in ("article", "main"):
        element.starts = tag
    if attributes.strip(" /"):
        lowered = attributes.lower()
        if re.search(r"(^|\s)hidden(\s|=|/|$)", lowered):
            element.hidden = HIDDEN
        found = [(name.lower(), a or b or c) for name, a, b, c in _ATTRIBUTE.findall(attributes)]
        section = tag == "section" or any(n == "class" and "section" in v.split() for n, v in found)
        for name, value in found:
            if name in ("class", "id"):
                slug = name == "id" and (tag in HEADINGS or section and article)
                if tag not in ("html", "body", "article", "main") and not slug:
                    _named(element, value)
            elif name == "role":
                role = value.lower()
                if role == "form":
                    element.wrapper = DROPPED
                elif role in ROLES and not (role == "banner" and article):
                    element.foreign = DROPPED
                elif role in ("main", "article"):
                    element.starts = role
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
                element.hidden = HIDDEN
            elif name == "aria-hidden" and value.lower() == "true":
                element.hidden = HIDDEN
    if element.starts in ("article", "main"):
        element.article = element.content = True
    return element


class Page:
    """Blocks of a page, in order, with the classifier's costs."""

    def __init__(self, source: str) -> None:
        self.elements = [Element("", -1)]
        self.blocks: list[Block] = []
        self.stack = [0]
        self._parts: list[str] = []
        self._linked = 0
        self._links = 0
        self._read_blocks: list[tuple[str, int, int]] = []
        self._read(source)
        self._inherit()
        for text, linked, at in self._read_blocks:
            place = self._place(at)
            self.blocks.append(Block(text, self._container(place), self._cost(text, linked, at, place)))

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        lower = None
        for token in iter(lambda: _TOKEN.search(source, at), None):
            if token.start() > at:
                self._text(source[at : token.start()])
            at = token.end()
            tag = (token[2] or token[5] or "").lower()
            if not tag:
                continue
            closing, attributes = token[1] or token[4], token[3] or token[6] or ""
            if closing:
                self._close(tag)
            elif tag in RAW_TAGS:
                if not attributes.endswith("/"):
                    lower = source.lower() if lower is None else lower
                    stop = lower.find(f"</{tag}", at) if len(lower) == end else source.find(f"</{tag}", at)
                    at = end if stop < 0 else stop
            else:
                self._open(tag, attributes)
            if at >= end:
                break
        if at < end:
            self._text(source[at:])
        self._flush()

    def _text(self, raw: str) -> None:
        self._parts.append(html.unescape(raw) if "&" in raw else raw)
        if self._links:
            self._linked += len(raw)

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._parts.append(" ")
            return
        if tag in BLOCK_TAGS:
            self._flush()
            # A paragraph or item that is still open ends here.
            while len(self.stack) > 1:
                top = self.elements[self.stack[-1]].tag
                if top == "p" or top == tag and tag in ("li", "td", "th", "tr", "dt", "dd", "option"):
                    self._pop()
                elif top not in BLOCK_TAGS and any(
                    self.elements[i].tag == "p" for i in self.stack[-4:-1]
                ):
                    self._pop()
                else:
                    break
        if tag in VOID_TAGS:
            return
        parent = self.stack[-1]
        self.elements.append(_element(tag, attributes, parent, self.elements[parent].article))
        self.stack.append(len(self.elements) - 1)
        self._links += tag == "a"

    def _close(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self._flush()
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.elements[self.stack[depth]].tag == tag:
                while len(self.stack) > depth:
                    self._pop()
                return
            # An inline end tag does not reach out of its block.
            if tag not in BLOCK_TAGS and self.elements[self.stack[depth]].tag in BLOCK_TAGS:
                return

    def _pop(self) -> None:
        self._links -= self.elements[self.stack.pop()].tag == "a"

    def _flush(self) -> None:
        if not self._parts:
            return
        text = " ".join("".join(self._parts).split())
        linked, self._parts, self._linked = self._linked, [], 0
        if not text:
            return
        self._read_blocks.append((text, linked, self.stack[-1]))

    def _place(self, at: int) -> int:
        """The block-level element around an element, or itself."""
        while self.elements[at].tag not in BLOCK_TAGS and at:
            at = self.elements[at].parent
        return at

    def _inherit(self) -> None:
        """Costs and content pass on to descendants, up to what ends them."""
        free, linked = [0] * len(self.elements), [0] * len(self.elements)
        for text, links, at in self._read_blocks:
            free[at] += max(0, len(text) - links)
            linked[at] += min(len(text), links)
        for i in range(len(self.elements) - 1, 0, -1):
            free[self.elements[i].parent] += free[i]
            linked[self.elements[i].parent] += linked[i]
        for i, element in enumerate(self.elements[1:], 1):
            most = free[i] > linked[i] and 2 * free[i] > free[0]
            if most:
                element.edge = element.wrapper = 0.0
            named = element.dropped < WEAK
            outer = self.elements[element.parent]
            element.hidden = min(element.hidden, outer.hidden)
            element.content = element.content or outer.content and not named
            if element.starts == "main" or element.starts == "article" and most:
                continue
            element.foreign = min(element.foreign, outer.foreign)
            element.edge = min(element.edge, outer.edge)
            if element.starts != "article":
                element.wrapper = min(element.wrapper, outer.wrapper)

    def _container(self, place: int) -> int:
        """The element that holds the block's own one, so paragraphs are siblings."""
        return max(0, self.elements[place].parent)

    def _cost(self, text: str, linked: int, at: int, place: int) -> float:
        element = self.elements[at]
        cost = BIAS + element.dropped
        if element.content:
            cost += IN_CONTENT
        tag = self.elements[place].tag
        if tag in ("p", "pre", "blockquote", "td"):
            cost += PARAGRAPH
        elif tag in HEADINGS or tag == "figcaption":
            cost += HEADING
        n = len(text)
        cost += LONG * min(1.0, n / 200) + SENTENCE * (text[-1] in ".!?:;\"”…")
        return cost + LINKS * min(1.0, linked / n)

    def tied(self) -> list[Block]:
        """The blocks with their smoothness edges."""
        latest: dict[int, int] = {}
        for i, block in enumerate(self.blocks):
            if i:
                self._tie(i - 1, i, NEAR)
            if block.parent in latest:
                self._tie(latest[block.parent], i, SIBLING)
            latest[block.parent] = i
        return self.blocks

    def _tie(self, i: int, j: int, capacity: float) -> None:
        for a, b in ((i, j), (j, i)):
            edges = self.blocks[a].edges
            edges[b] = edges.get(b, 0.0) + capacity


def minimum_cut(costs: list[float], edges: list[dict[int, float]]) -> list[bool]:
    """True for each node on the source side of a minimum cut.

    A positive cost is a capacity from the source, a negative one a capacity to the sink;
    edges have the same capacity both ways. Of equal cuts the one with the fewest nodes on
    the source side counts among the nodes that the flow decides.
    """
    cost, left = list(costs), [dict(e) for e in edges]
    side: list[bool | None] = [None] * len(cost)
    queue = deque(range(len(cost)))
    while queue:
        i = queue.popleft()
        if side[i] is not None or abs(cost[i]) < sum(left[i].values()) or not cost[i] and left[i]:
            continue
        side[i] = cost[i] > 0
        for j, capacity in left[i].items():
            del left[j][i]
            cost[j] += capacity if side[i] else -capacity
            queue.append(j)
        left[i] = {}
    nodes = [i for i in range(len(cost)) if side[i] is None]
    if nodes:
        reached = _flow(nodes, cost, left)
        for i in nodes:
            side[i] = i in reached
    return [bool(s) for s in side]


def _flow(nodes: list[int], cost: list[float], edges: list[dict[int, float]]) -> set[int]:
    """Nodes that the source still reaches after a maximum flow, by shortest paths."""
    source, sink = -1, -2
    rest: dict[int, dict[int, float]] = {i: dict(edges[i]) for i in nodes}
    rest[source] = {i: cost[i] for i in nodes if cost[i] > 0}
    rest[sink] = {}
    for i in nodes:
        if cost[i] < 0:
            rest[i][sink] = -cost[i]
    while True:
        before: dict[int, int] = {source: source}
        queue = deque([source])
        while queue and sink not in before:
            i = queue.popleft()
            for j, capacity in rest[i].items():
                if capacity > 1e-9 and j not in before:
                    before[j] = i
                    queue.append(j)
        if sink not in before:
            return set(before)
        path, j = [], sink
        while j != source:
            path.append((before[j], j))
            j = before[j]
        amount = min(rest[i][j] for i, j in path)
        for i, j in path:
            rest[i][j] -= amount
            if j != sink and i != source:
                rest[j][i] = rest[j].get(i, 0.0) + amount


def main_text(source: str) -> tuple[str, int, int]:
    """Text of the blocks on the content side, their number and that of all blocks."""
    blocks = Page(source).tied()
    costs, edges = [b.cost for b in blocks], [b.edges for b in blocks]
    keep = minimum_cut(costs, edges)
    if not any(keep):
        # Short blocks in plain elements: nothing speaks for them, nor against them. Ties to
        # blocks that something speaks against say nothing here.
        plain = [{j: c for j, c in e.items() if min(costs[i], costs[j]) >= BIAS} for i, e in enumerate(edges)]
        keep = minimum_cut([c + PLAIN for c in costs], plain)
    kept = [b.text for b, k in zip(blocks, keep, strict=True) if k]
    return " ".join(kept), len(kept), len(blocks)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in tx.pieces(batch):
            found = [main_text(source or "") for source in piece.column(1).to_pylist()]
            texts, kept, blocks = zip(*found, strict=True)
            yield pa.record_batch(
                [
                    piece.column(0), piece.column(2), pa.array(texts, pa.string()),
                    pa.array(kept, pa.int64()), pa.array(blocks, pa.int64()),
                ],
                names=["page_id", "url", "text", "n_kept", "n_blocks"],
            )


def extract_text(pages: DataFrame) -> DataFrame:
    """Main text of ``page_id, url, html``: the same with text, n_kept and n_blocks.

    One row for each row given, repeated rows included. A null or empty page, and one
    without content, has an empty text. An empty table gives no rows; other columns are not
    read. References are decoded, white space in a block becomes one space, and blocks are
    joined by one space in the order of the page.
    """
    schema = "page_id bigint, url string, text string, n_kept bigint, n_blocks bigint"
    return pages.select("page_id", "html", "url").mapInArrow(_extract, schema)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "n_kept", "n_blocks"
    )
