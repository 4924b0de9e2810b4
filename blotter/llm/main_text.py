"""The main text of web pages, by a minimum cut between content and boilerplate.

A page is cut into blocks of text. A small classifier turns what is known of a block
(the elements around it, its length, its links) into the cost of calling it content
or boilerplate; these are the capacities of its edges to the two terminals. Blocks
that follow each other or stand close in the document tree are joined by smoothness
edges. The minimum cut is the labelling of least total cost.
"""

from __future__ import annotations

import re
from collections import deque
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.frames import text_of

# Elements that end a block of text where they begin and end.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol"
    " optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Elements without text of the page's own, and those whose content is not markup.
_SILENT = frozenset(
    "audio button canvas datalist head iframe math noscript object progress script select style svg"
    " template textarea title video".split()
)
_RAW = frozenset("script style textarea title iframe noscript".split())
# What an element's begin closes if it is open.
_CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
# An element is not closed from outside of these.
_FENCES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",)}
_CELLS = ("table",)

# Elements and roles that hold boilerplate, whatever is in them.
_BOILER = frozenset("nav aside footer dialog menu search".split())
_BOILER_ROLES = frozenset(
    "navigation complementary contentinfo banner search dialog alertdialog alert menu menubar toolbar".split()
)
# These may also wrap a whole page or an article's own head.
_WEAK = frozenset("header form fieldset".split())
_CONTENT = frozenset("article main".split())

_BOILER_WORDS = (
    "ads?|advert(?:s|isement|ising)?|adsense|banner|breadcrumbs?|byline|cookies?|consent|comments?|commentlist"
    "|comment-?list|copyright|disclaimer|discussion|disqus|dropdown|feedback|footer|gdpr|login|masthead|menu"
    "|modal|nav|navbar|navigation|newsletter|notices?|notification|overlay|pager|pagination|popup|promos?"
    "|promotion|recommended|related|repl(?:y|ies)|respond|search|share|sharing|sidebar|signup|site-?header"
    "|skip|social|sponsor(?:ed)?|subscribe|tags?|toolbar|top-?bar|widgets?"
)
_BOILER_NAME = re.compile(
    rf"(?i)^(?:{_BOILER_WORDS})(?:$|[-_0-9])|[-_](?:{_BOILER_WORDS})$"
)
# Names that say what a layout has or lacks.
_LAYOUT_NAME = re.compile(r"(?i)^(?:has|no|with)[-_]")
# Boilerplate that is made of others' articles.
_OTHERS_NAME = re.compile(
    r"(?i)(?:^|[-_])(?:ads?|advert\w*|comments?|commentlist|discussion|disqus|promos?|promotion|recommended|related"
    r"|repl(?:y|ies)|respond|sponsor(?:ed)?)(?:$|[-_0-9])"
)
_HEADER_NAME = re.compile(r"(?i)^(?:page-?|main-?)?header$")
_CONTENT_NAME = re.compile(
    r"(?i)^(?:article|post|entry|story|content|main|body|text)(?:$|[-_]?(?:body|content|text|article|main|inner|wrapper|wrap|container|area|section)\b)"
    r"|^(?:main|page|article|post|entry|story|body)[-_]?(?:content|body|text|article)$"
)
# Content names that are not also usual within a widget.
_OWN_NAME = re.compile(r"(?i)^(?:main|page|article|post|entry|story|body)[-_]?(?:content|body|text|article)$")

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>",
    re.S,
)
#: What begins a tag that the page ends in.
_UNENDED = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN_STYLE = re.compile(r"(?i)(?:display\s*:\s*none|visibility\s*:\s*hidden)")
_NOTE = re.compile(
    r"(?i)^(?:©|\(c\)|copyright\b)|\ball rights reserved\b|\bcookies?\b.{0,40}\b(?:accept|use|policy)\b"
    r"|\bprivacy policy\b|\bsubscribe\b|\bsign (?:in|up)\b"
)
_SENTENCE_ENDS = (".", "!", "?", "…", "。", ":", '"', "”", "»")

# What the classifier adds for a block, in favour of content.
PRIOR = -0.4
IN_CONTENT = 3.0
IN_BOILER = -7.0
IN_WEAK = -4.0
PER_LOG_WORD = 0.5
ENDS_SENTENCE = 0.6
LINKED = -4.0
NOTE = -2.0
TAGS = {"p": 1.0, "pre": 1.0, "blockquote": 1.0, "h1": 0.8, "h2": 0.4, "h3": 0.4, "h4": 0.3, "li": -0.2}
#: Smoothness between blocks one after the other, and one further on under one parent.
NEXT = 1.2
SIBLING = 0.4


class _Element:
    """An open element that ends blocks; it knows its parent, so no block needs its whole path."""

    __slots__ = ("parent", "depth", "tag")

    def __init__(self, parent: _Element | None, tag: str):
        self.parent, self.tag = parent, tag
        self.depth: int = parent.depth + 1 if parent else 0


class _Block:
    __slots__ = ("pieces", "linked", "within", "role")

    def __init__(self, within: _Element, role: str):
        self.pieces: list[str] = []
        self.linked = 0
        self.within, self.role = within, role


def _role(name: str, rest: str, outer: str) -> str | None:
    """What an element makes of its content: boiler, named, weak, content, outer's; None if hidden.

    Boilerplate stays what it is whatever it contains. What only a class or id names
    so (named) gives way to main, article, and names of a page's own content.
    """
    marks: list[str] = []
    ids: list[str] = []
    role = ""
    if rest:
        for key, a, b, c in _ATTRIBUTE.findall(rest):
            key, value = key.lower(), unescape(a or b or c)
            if key in ("class", "id"):
                marks += value.split()
                if key == "id":
                    ids += value.split()
            elif key == "role":
                role = value.strip().lower()
            elif key == "itemprop" and value.lower() == "articlebody":
                role = "main"
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                return None
            elif key == "style" and _HIDDEN_STYLE.search(value):
                return None
    if outer == "boiler" or name in _BOILER or role in _BOILER_ROLES:
        return "boiler"
    if name in ("html", "body"):
        return outer
    content = any(_CONTENT_NAME.search(mark) for mark in marks)
    boiler = [mark for mark in marks if _BOILER_NAME.search(mark) and not _LAYOUT_NAME.search(mark)]
    if name not in _CONTENT and not content and boiler:
        return "boiler" if any(map(_OTHERS_NAME.search, boiler)) else "named"
    if name == "article" and any(re.match(r"(?i)comment|reply", mark) for mark in marks):
        return "boiler"
    if outer == "named" and name not in _CONTENT and role not in ("main", "article"):
        own = any(map(_CONTENT_NAME.search, ids)) or any(map(_OWN_NAME.search, marks))
        return "content" if own else "named"
    if name in _CONTENT or role in ("main", "article") or content:
        return "content"
    if outer != "content" and (name in _WEAK or any(_HEADER_NAME.search(mark) for mark in marks)):
        return "weak"
    return "weak" if outer == "content" and name in ("form", "fieldset") else outer


def _blocks(html: str) -> list[_Block]:
    out: list[_Block] = []
    # Open elements: name, innermost block element, role; role None where nothing inside is shown.
    stack: list[tuple[str, _Element, str | None]] = [("", _Element(None, ""), "")]
    # Places in the stack by name, so that no tag has to look through all open elements.
    places: dict[str, list[int]] = {}
    titles = True
    current: _Block | None = None
    links = 0
    at, end = 0, len(html)
    last = html.rfind(">") + 1  # no tag ends after it

    def text(piece: str) -> None:
        nonlocal current
        if not piece or stack[-1][2] is None:
            return
        if current is None:
            if piece.isspace():
                return
            current = _Block(stack[-1][1], stack[-1][2])
            out.append(current)
        if "&" in piece:
            piece = unescape(piece)
        current.pieces.append(piece)
        if links:
            current.linked += len(piece)

    def close(place: int) -> None:
        nonlocal current, links
        for name, _, _ in stack[place:]:
            places[name].pop()
            if name in _BLOCKS:
                current = None
            elif name == "a":
                links -= 1
        del stack[place:]

    def latest(*names: str) -> int:
        """Place of the innermost open element of these names; 0 if there is none."""
        return max(places[name][-1] if places.get(name) else 0 for name in names)

    while at < end:
        found = _TAG.search(html, at, last) if at < last else None
        if found is None:
            rest = html[at:]
            unended = _UNENDED.search(rest)
            text(rest[: unended.start()] if unended else rest)
            break
        text(html[at : found.start()])
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        if found["end"] or found["end2"]:
            if place := latest(name):
                close(place)
            elif name in _BLOCKS:
                current = None
            continue
        rest = found["rest"] or found["rest2"] or ""
        if name == "br":
            text(" ")
            continue
        if name in _BLOCKS:
            current = None
            shut = _CLOSES.get(name, ())
            fence = latest(*_FENCES.get(name, _CELLS))
            while stack[-1][1].tag == "p" or shut:
                place = latest("p", *shut)
                if place <= fence:
                    break
                closed = stack[place][0]
                close(place)
                if closed == name:
                    break
        if name in _VOID:
            continue
        outer = stack[-1][2]
        role = None if outer is None or name in _SILENT else _role(name, rest, outer)
        if name in _RAW:
            if name == "title" and not titles:
                continue
            closing = re.compile(rf"</{name}[\s/>]", re.I).search(html, at)
            if closing is None and name == "title":
                titles = False  # nor will a later one be closed
                continue
            at = closing.start() if closing else end
        if rest.endswith("/") and name not in _BLOCKS:
            continue
        within = stack[-1][1]
        places.setdefault(name, []).append(len(stack))
        stack.append((name, _Element(within, name) if name in _BLOCKS else within, role))
        if name == "a":
            links += 1
    return out


def _evidence(block: _Block, text: str) -> float:
    words = text.count(" ") + 1
    score = PRIOR + TAGS.get(block.within.tag, 0.0) + PER_LOG_WORD * (np.log1p(words) - 1.5)
    score += LINKED * min(1.0, block.linked / max(1, len(text)))
    if text.endswith(_SENTENCE_ENDS):
        score += ENDS_SENTENCE
    score += {"content": IN_CONTENT, "boiler": IN_BOILER, "named": IN_BOILER, "weak": IN_WEAK}.get(block.role, 0.0)
    if words <= 30 and block.role != "content" and _NOTE.search(text):
        score += NOTE
    return float(score)


def minimum_cut(evidence: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut.

    A node has an edge from the source (positive evidence) or to the sink (negative)
    of that capacity; `edges` join nodes in both directions. Maximum flow by blocking
    flows along shortest paths.
    """
    n = len(evidence)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    heads: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, forth: float, back: float) -> None:
        graph[a].append(len(heads))
        heads.append(b)
        room.append(forth)
        graph[b].append(len(heads))
        heads.append(a)
        room.append(back)

    for node, value in enumerate(evidence):
        if value > 0:
            join(source, node, value, 0.0)
        elif value < 0:
            join(node, sink, -value, 0.0)
    for a, b, weight in edges:
        join(a, b, weight, weight)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            node = queue.popleft()
            for edge in graph[node]:
                to = heads[edge]
                if room[edge] > tiny and level[to] < 0:
                    level[to] = level[node] + 1
                    queue.append(to)
        if level[sink] < 0:
            return [level[node] >= 0 for node in range(n)]
        upto = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(room[edge] for edge in path)
                for edge in path:
                    room[edge] -= flow
                    room[edge ^ 1] += flow
                # Back to the first edge that is full.
                full = next(k for k, edge in enumerate(path) if room[edge] <= tiny)
                node = heads[path[full] ^ 1]
                del path[full:]
                continue
            while upto[node] < len(graph[node]):
                edge = graph[node][upto[node]]
                if room[edge] > tiny and level[heads[edge]] == level[node] + 1:
                    break
                upto[node] += 1
            else:
                if node == source:
                    break
                edge = path.pop()
                node = heads[edge ^ 1]
                upto[node] += 1
                continue
            path.append(edge)
            node = heads[edge]


def _apart(a: _Element, b: _Element) -> int:
    """Steps from the one up to the common element and down to the other, less one on each side.

    Blocks follow each other as the page's elements do, so the steps of all neighbours
    together are at most two an element.
    """
    up = down = 0
    while a is not b:
        if a.depth >= b.depth and a.parent:
            a, up = a.parent, up + 1
        else:
            b, down = b.parent, down + 1
    return max(0, up - 1) + max(0, down - 1)


def _smoothness(blocks: list[_Block]) -> list[tuple[int, int, float]]:
    edges = []
    for k in range(1, len(blocks)):
        a, b = blocks[k - 1].within, blocks[k].within
        edges.append((k - 1, k, NEXT / (1 + _apart(a, b))))
        if k > 1:
            c = blocks[k - 2].within
            if (c.parent or c) is (b.parent or b):
                edges.append((k - 2, k, SIBLING))
    return edges


#: Words of a block of prose at least, and blocks of prose of a page whose wrapper counts for nothing.
PROSE_WORDS = 8
PROSE_BLOCKS = 3


def _unwrapped(found: list[tuple[_Block, str]]) -> None:
    """Takes back weak and named roles on a page that has its prose in nothing else.

    A form or a name may wrap a whole page. Where no element is content by its own kind,
    and most blocks of prose (sentences that are not links) have such a role, it tells
    nothing.
    """
    if any(block.role == "content" for block, _ in found):
        return
    prose = [
        block.role
        for block, text in found
        if block.role != "boiler"
        and text.count(" ") + 1 >= PROSE_WORDS
        and text.endswith(_SENTENCE_ENDS)
        and 2 * block.linked < len(text)
    ]
    wrapped = sum(role in ("weak", "named") for role in prose)
    if wrapped >= PROSE_BLOCKS and 2 * wrapped > len(prose):
        for block, _ in found:
            if block.role in ("weak", "named"):
                block.role = ""


def main_text(html: str) -> str:
    """The content blocks of a page in order, joined by an empty line.

    White space inside a block is one space. Without content the text is empty.
    """
    found = [(block, " ".join("".join(block.pieces).split())) for block in _blocks(html)]
    found = [(block, text) for block, text in found if text]
    _unwrapped(found)
    blocks = [block for block, _ in found]
    kept = minimum_cut([_evidence(*one) for one in found], _smoothness(blocks))
    return "\n\n".join(text for (_, text), keep in zip(found, kept) if keep)


def extract(html: Column) -> Column:
    """The main text of a column of pages."""

    @F.arrow_udf("string")
    def texts(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(page.as_py()) for page in pages], pa.string())

    return texts.asNondeterministic()(html)


def extracted(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per page: id, url, text, n_chars (code points of the text).

    One row per input row, repeated rows included. A null or empty page, and one
    without content, has an empty text. Other columns are not read.
    """
    found = pages.select(
        F.col(f"`{id_col}`").alias(id_col),
        F.col(f"`{url_col}`").alias(url_col),
        extract(text_of(html_col)).alias("text"),
    )
    return found.withColumn("n_chars", F.length("text").cast("long"))
