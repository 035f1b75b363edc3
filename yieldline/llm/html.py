"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text. A linear classifier gives each block a cost of being called content or boilerplate, from its
containers, links, length and punctuation; these are the capacities to the two terminals. Neighbours in page order and
blocks of one container are joined by smoothness edges, the stronger the closer they are in the document tree. The
minimum cut separates content from boilerplate at the least total cost.

Pages are independent: one map over the table, no shuffle, and a task holds one slice of pages.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import escape, unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldline.llm.columns import slices

SLICE = 4 << 20

# Fixed values of HTML: elements that start a block, whose content is no text, and that end others implicitly.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot "
    "th thead tr ul button iframe xmp noframes".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style title textarea noscript template svg iframe xmp head".split())
ENDS_PARAGRAPH = BLOCK - {"body", "html", "option", "optgroup", "tbody", "thead", "tfoot", "tr", "td", "th", "button", "iframe"}
HOLD_PARAGRAPHS = ("button", "td", "th", "div", "section", "article", "blockquote", "li")
SAME_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Classifier: what containers and class names say.
OUTSIDE = frozenset("nav footer aside button select menu".split())
# These can hold a whole page, so they are evidence that text outweighs, and an article in them counts as one.
MAY_HOLD_ALL = frozenset("form fieldset dialog".split())
MAY_HOLD_ALL_ROLES = frozenset("form dialog".split())
INSIDE = frozenset("article main".split())
# Names are looked at as whole tokens: outside if every part is a name of boilerplate or of layout (site-footer, not no-sidebar).
NOT_ARTICLE = r"ads?|advert[a-z0-9]*|sponsor[a-z0-9]*|promo[a-z0-9]*|cookie[a-z0-9]*|consent|gdpr|disclaimer|comments?|commentlist|replies|reply|respond|disqus[a-z0-9]*|" \
    r"newsletter|subscri[a-z0-9]*|popup|copyright|paywall"
AROUND = r"banner[a-z0-9]*|notices?|alert|sidebar[a-z0-9]*|menu[a-z0-9]*|nav|navbar|navigation|breadcrumbs?|footer|masthead|topbar|toolbar|share|sharing|" \
    r"social|related|recommend[a-z0-9]*|login|signup|modal|overlay|widget|tags|pagination|pager|skip|hidden"
LAYOUT = r"site|page|main|post|posts|entry|article|articles|stories|left|right|top|bottom|primary|secondary|wrapper|wrap|container|area|box|" \
    r"block|list|links?|items?|bar|inner|outer|section|title|form|buttons?|visually|js|wp|mw|[a-z]|\d+"
OUTSIDE_TOKEN = re.compile(rf"(?:(?:{LAYOUT})[_-]+)*(?:{NOT_ARTICLE}|{AROUND})(?:[_-]+(?:{LAYOUT}|{NOT_ARTICLE}|{AROUND}))*", re.I)
NOT_ARTICLE_PART = re.compile(rf"(?:^|[_-])(?:{NOT_ARTICLE})(?=$|[_-])", re.I)
OUTSIDE_PART = re.compile(rf"(?:^|[_-])(?:{NOT_ARTICLE}|{AROUND})(?=$|[_-])", re.I)
INSIDE_PART = re.compile(r"(?:^|[_-])(?:article|content|post|entry|story|main|text|body)(?=$|[_-])", re.I)
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert menu menubar toolbar".split())
OUTSIDE_COST, INSIDE_COST, NAMED_COST = -8.0, 4.0, 1.0
# Names speak against content as much as long text (AROUND) or text and its neighbours (NOT_ARTICLE) can outweigh.
AROUND_COST, NOT_ARTICLE_COST = -1.6, -4.0
# Classifier: what the text says.
BASE_COST, WORDS_COST, MOST_WORDS_COST, SENTENCE_COST, HEADING_COST, LINK_COST, ITEM_COST = -0.6, 0.06, 2.0, 0.8, 0.6, -3.0, -0.4
# Smoothness: neighbours in page order, blocks of the same container; divided by the steps between their containers.
NEXT_COST, SIBLING_COST = 1.8, 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>|<[!?/][^>]*+>|<[a-zA-Z/!?][^>]*+\Z", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK))})(?=[\s/>])", re.I)
_FOREIGN = re.compile(r"<foreignobject(?=[\s/>])", re.I)
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}


class Container:
    """An open or closed element that holds blocks, and what it says about them."""

    __slots__ = ("name", "parent", "depth", "outside", "cost", "article", "unseen", "paragraph")

    def __init__(self, name: str, parent: Container | None, attributes: str):
        self.name, self.parent = name, parent
        self.depth = parent.depth + 1 if parent else 0
        self.outside = parent.outside if parent else False
        self.cost = parent.cost if parent else 0.0
        self.article = parent.article if parent else False  # whether it is within an article
        self.unseen = parent.unseen if parent else False  # whether all that speaks against it is that it is hidden
        # Whether a paragraph is open that the next block would end.
        self.paragraph = name == "p" or bool(parent and parent.paragraph and name not in HOLD_PARAGRAPHS)
        named = {}
        if attributes and not attributes.isspace():
            for key, a, b, c in _ATTRIBUTE.findall(attributes):
                named.setdefault(key.lower(), a or b or c)
        words = f"{named.get('class', '')} {named.get('id', '')}" if named else ""
        role = named.get("role", "").lower()
        if name == "aside" and self.article and not self.outside:
            self.cost += NOT_ARTICLE_COST
        elif name in OUTSIDE or role in OUTSIDE_ROLES or (name == "header" and not self.article):
            self.outside, self.unseen, self.cost = True, False, OUTSIDE_COST
        elif named and ("hidden" in named or "display:none" in named.get("style", "").replace(" ", "").lower()):
            self.outside, self.unseen, self.cost = True, self.unseen or not self.outside, OUTSIDE_COST
        elif name in INSIDE and (not self.outside or self.unseen):
            self.outside, self.unseen, self.cost = False, False, INSIDE_COST
        elif not self.outside and (name in MAY_HOLD_ALL or role in MAY_HOLD_ALL_ROLES):
            self.cost = min(self.cost, 0.0) + AROUND_COST
        elif words and not self.outside:
            self._weigh(words.split(), name in ("body", "html"))
        self.article |= name in INSIDE

    def _weigh(self, tokens: list[str], whole_page: bool) -> None:
        """Put what names say into the cost: boilerplate from here on counts from 0, also within an article."""
        outside = [t for t in tokens if not whole_page and OUTSIDE_TOKEN.fullmatch(t)]
        if outside:
            named = NOT_ARTICLE_COST if any(NOT_ARTICLE_PART.search(t) for t in outside) else AROUND_COST
            self.cost = max(min(self.cost, 0.0) + named, NOT_ARTICLE_COST)
        if any(INSIDE_PART.search(t) and not OUTSIDE_PART.search(t) for t in tokens):
            self.cost = min(self.cost + NAMED_COST, INSIDE_COST)

    def steps_to(self, other: Container) -> int:
        """Elements between two containers, by way of the one that holds both."""
        a, b, steps = self, other, 0
        while a is not b:
            steps += 1
            if a.depth >= b.depth:
                a = a.parent
            else:
                b = b.parent
        return steps


class Block:
    """A run of text without a block boundary."""

    __slots__ = ("container", "text", "cost")

    def __init__(self, container: Container, text: str, linked: int):
        self.container, self.text = container, text
        words = text.count(" ") + 1
        cost = BASE_COST + container.cost + min(WORDS_COST * words, MOST_WORDS_COST)
        if words >= 4 and text[-1] in ".!?…:;\"”»":
            cost += SENTENCE_COST
        if container.name in HEADINGS:
            cost += HEADING_COST
        if container.name in ("li", "td", "dd", "option"):
            cost += ITEM_COST
        self.cost = cost + LINK_COST * min(1.0, linked / max(1, len(text)))


def blocks_of(html: str) -> list[Block]:
    """Blocks of a page in order. Repairs open elements as browsers do as far as blocks are concerned."""
    at = root = Container("#page", None, "")
    blocks: list[Block] = []
    parts: list[str] = []
    linked, in_link, last = 0, 0, 0
    endless: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                blocks.append(Block(at, text, linked))
            parts.clear()
        linked = 0

    position, match = 0, _TOKEN.search(html)
    while match is not None:
        if match.start() > last:
            run = html[last : match.start()]
            parts.append(run)
            if in_link:
                linked += len(run)
        last = position = match.end()
        name = match[2]
        if name is not None:
            name = name.lower()
            if not match[1]:
                if name in RAW and name != "head":
                    if name == "textarea" or name in BLOCK:
                        flush()
                    if name == "svg" and match[3].endswith("/"):
                        pass
                    elif name in ("svg", "template"):
                        last = position = _after(name, html, position, endless)
                    else:
                        end = _ENDS[name].search(html, position)
                        if name == "xmp":
                            parts.append(escape(html[position : end.start() if end else len(html)]))
                            at = Container(name, at, match[3])
                            flush()
                            at = at.parent
                        last = position = end.end() if end else len(html)
                elif name == "br":
                    parts.append(" ")
                elif name == "a":
                    in_link = 1
                elif name in BLOCK:
                    flush()
                    if name == "hr":
                        pass
                    else:
                        if name in ENDS_PARAGRAPH and at.paragraph:
                            at = _closed(at, {"p"}, root, HOLD_PARAGRAPHS)
                        if name in SAME_KIND:
                            at = _closed(at, SAME_KIND[name], root, ("ul", "ol", "dl", "table", "select", "menu"))
                        if name not in VOID:
                            at = Container(name, at, match[3])
            elif name == "a":
                in_link = 0
            elif name in BLOCK:
                flush()
                in_link = 0
                open_ = at
                while open_ is not root and open_.name != name:
                    open_ = open_.parent
                if open_ is not root and name not in ("body", "html"):
                    at = open_.parent
        match = _TOKEN.search(html, position)
    if last < len(html):
        parts.append(html[last:])
    flush()
    return blocks


def _after(name: str, html: str, position: int, endless: set[str]) -> int:
    """Where the page goes on after an svg or template: behind its end tag, or at the next block element if it has none.

    An svg ends at a block element as in browsers, unless that is within a foreignObject. `endless` remembers names that have no
    end tag in the rest of the page.
    """
    block = _BLOCK_TAG.search(html, position)
    stop = block.start() if block else len(html)
    end = _ENDS[name].search(html, position, stop)
    if not end and name not in endless and (name == "template" or _FOREIGN.search(html, position, stop)):
        end = _ENDS[name].search(html, stop)
        if not end:
            endless.add(name)
    return end.end() if end else stop


def _closed(at: Container, kinds: set[str], root: Container, within: tuple[str, ...]) -> Container:
    """The container after implicitly ending an open element of these kinds, looking no further than `within`."""
    open_ = at
    while open_ is not root and open_.name not in within:
        if open_.name in kinds:
            return open_.parent
        open_ = open_.parent
    if open_ is not root and open_.name in kinds:
        return open_.parent
    return at


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours in page order, and the next block of the same container."""
    edges = []
    latest: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEXT_COST / (1 + blocks[i - 1].container.steps_to(block.container))))
        holder = id(block.container.parent or block.container)
        if holder in latest and latest[holder] < i - 1:
            edges.append((latest[holder], i, SIBLING_COST))
        latest[holder] = i
    return edges


def labelled(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for content: the labelling of least cost, by maximum flow.

    costs > 0 speak for content. A node whose own cost is at least that of all its edges has its label in some least
    labelling; it is settled and its edges go into its neighbours' costs. What remains is solved by maximum flow; ties go to
    content.
    """
    own = list(costs)
    near: list[dict[int, float]] = [{} for _ in costs]
    for a, b, c in edges:
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    label: list[bool | None] = [None] * len(costs)
    todo = deque(range(len(costs)))
    while todo:
        i = todo.popleft()
        if label[i] is None and abs(own[i]) >= sum(near[i].values()):
            label[i] = own[i] >= 0
            for j, c in near[i].items():
                own[j] += c if label[i] else -c
                del near[j][i]
                todo.append(j)
            near[i] = {}
    rest = [i for i, x in enumerate(label) if x is None]
    if rest:
        reached = _source_side(own, near, rest)
        for i in rest:
            label[i] = i in reached
    return [bool(x) for x in label]


def _source_side(own: list[float], near: list[dict[int, float]], rest: list[int]) -> set[int]:
    """Nodes that cannot reach the boilerplate terminal in the residual graph of a maximum flow (shortest paths first)."""
    source, sink = -1, -2
    left: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest}
    left[source], left[sink] = {}, {}
    for i in rest:
        if own[i] >= 0:
            left[source][i], left[i][source] = own[i], 0.0
        else:
            left[i][sink], left[sink][i] = -own[i], 0.0
    tiny = 1e-12
    while True:
        before: dict[int, int] = {source: source}
        queue = deque([source])
        while queue and sink not in before:
            i = queue.popleft()
            for j, c in left[i].items():
                if c > tiny and j not in before:
                    before[j] = i
                    queue.append(j)
        if sink not in before:
            break
        path, at = [], sink
        while at != source:
            path.append((before[at], at))
            at = before[at]
        flow = min(left[i][j] for i, j in path)
        for i, j in path:
            left[i][j] -= flow
            left[j][i] = left[j].get(i, 0.0) + flow
    # Boilerplate is what still reaches the sink; ties stay on the content side.
    lost, queue = {sink}, deque([sink])
    while queue:
        i = queue.popleft()
        for j in left[i]:
            if j not in lost and left[j].get(i, 0.0) > tiny:
                lost.add(j)
                queue.append(j)
    return {i for i in rest if i not in lost}


def main_text(html: str) -> str:
    """Content blocks joined by line feeds."""
    blocks = blocks_of(html)
    kept = labelled([b.cost for b in blocks], edges_of(blocks))
    return "\n".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def extract(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """`pages` with the main text of each page, empty if it has none. Null html is empty.

    White space within a block becomes one space, character references are decoded once. All rows and other columns
    stay; a column named like `into` is replaced. Repeated rows get the same text.
    """
    base = pages.drop(into)
    schema = base.withColumn(into, F.lit("")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html, SLICE):
            texts = [main_text(h) if h else "" for h in batch.column(batch.schema.get_field_index(html)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, into])

    return base.mapInArrow(work, schema)
