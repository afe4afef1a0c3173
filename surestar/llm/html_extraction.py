"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks. A small classifier gives each block a cost for either label from its words, links, tag and the
marks of the elements around it; the difference is the capacity of its edge to the source (content) or to the sink
(boilerplate). Blocks that follow each other, and blocks that follow each other below one parent, are tied by edges that are the
stronger the nearer they stand in the document tree. The minimum cut of this network is the cheapest labelling; the blocks on the
side of the source are the text. Whole pages are read; each page is a row of its own, so nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements of HTML whose content is never text, that end a block, and that end an open element of their kind.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "math", "textarea", "select", "title", "object", "canvas", "audio", "video")
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements around a text that mark it as boilerplate, as the article, and kinds of text.
AWAY = frozenset("nav aside footer button menu dialog fieldset label legend search head optgroup option".split())
HOME = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Words in class, id and role that mark boilerplate, or the article.
AWAY_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright "
    "disclaimer discussion disqus dropdown footer footnotes form gdpr hidden login menu modal nav navbar navigation newsletter notice notices notification "
    "outbrain overlay pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe subscription taboola toolbar widget widgets complementary contentinfo alert".split()
)
HEADER_WORDS = frozenset(("header", "masthead", "topbar", "banner"))
HOME_WORDS = frozenset(("article", "content", "entry", "main", "post", "story", "text"))
#: Words that make a name say how an element is laid out, or what goes with it, and not what it is.
STATE_WORDS = frozenset(("has", "is", "no", "not", "overflow", "with", "without"))

#: The rest of a start tag. A quote opens a value only after an equals sign; elsewhere it is a character like others.
_ATTRIBUTES = r"(?:=\s*+\"[^\"]*\"|=\s*+'[^']*'|[^>])*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:svg|math)\b{_ATTRIBUTES}(?<=/)>|<({'|'.join(RAW)})\b{_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRIBUTES})(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
#: Scale of the capacities, which are whole numbers.
UNIT = 100


class Block:
    """A run of text without a block element in it, with what the classifier needs to know of its place."""

    __slots__ = ("away", "depth", "home", "link_chars", "marked", "parent", "parts", "tag", "text", "unit")

    def __init__(self, tag: str, parent: int, depth: int, away: bool, home: bool, marked: bool) -> None:
        self.tag, self.parent, self.depth, self.away, self.home, self.marked = tag, parent, depth, away, home, marked
        self.parts: list[str] = []
        self.link_chars, self.text = 0, ""
        self.unit = -1  # number of the outermost article or main around it

    @property
    def words(self) -> float:
        """Number of words outside links."""
        return (self.text.count(" ") + 1) * (1 - min(1.0, self.link_chars / max(1, len(self.text))))


class Element:
    """An open or closed block element: where it hangs, and what its tag and its attributes say of it.

    ``hard`` holds for all that lies in it; ``soft``, of forms and from names, gives way to an article and to the text of the page;
    ``hidden`` gives way to the text of the page only, which a script may show.
    """

    __slots__ = ("article_words", "hard", "hidden", "home", "hints", "marked", "parent", "soft", "tag", "words")

    def __init__(self, tag: str, parent: int, hard: bool, soft: bool, home: bool, marked: bool, hidden: bool = False) -> None:
        self.tag, self.parent, self.hard, self.soft, self.home, self.marked, self.hidden = tag, parent, hard, soft, home, marked, hidden
        self.words = self.article_words = 0.0
        self.hints = 0  # of the main text in it: headings of the page, articles and names that mark one


def _marks(tag: str, attributes: str, in_home: bool) -> tuple[bool, bool, bool]:
    """Whether the attributes of a start tag hide it, whether its names mark boilerplate, and whether they mark the article.

    A name such as ``has-sidebar`` says nothing. One that ends in a word for boilerplate marks it; one that has such a word
    elsewhere does so unless another name of the element marks the article.
    """
    if not attributes or tag in ("html", "body"):
        return False, False, False
    if _HIDDEN.search(attributes):
        return tag not in HOME, False, False
    away = home = beside = header = False
    for m in _MARKS.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            parts = [p.lower() for p in _PARTS.findall(name)]
            if not parts or not STATE_WORDS.isdisjoint(parts):
                continue
            away = away or parts[-1] in AWAY_WORDS
            found = not AWAY_WORDS.isdisjoint(parts)
            beside = beside or found
            home = home or (not found and not HOME_WORDS.isdisjoint(parts))
            header = header or not HEADER_WORDS.isdisjoint(parts)
    soft = away or (not home and (beside or (not in_home and header)))
    return False, soft, home and not soft


def _settle(elements: list[Element], blocks: list[Block]) -> None:
    """Set ``away`` of the blocks, ``marked`` and ``unit`` from the elements around them.

    A name that marks boilerplate, a form or a hidden element doesn't count on an element with more than half of the words of the page, unless what speaks for
    the main text lies outside it. Of an element that it counts on, a ``main`` is left out, and an ``article`` with more than
    half of the words that the articles in it have, if they have no such names themselves; of a hidden element nothing is left out.
    """
    for b in blocks:
        if not elements[b.parent].hard:
            elements[b.parent].words += b.words
    for e in reversed(elements):  # inner elements have the higher numbers
        if e.tag == "article":
            e.article_words = e.words
        if not e.hard and e.words and (e.tag == "h1" or e.marked or (e.tag in HOME and not e.soft)):
            e.hints += 1
        if e.parent >= 0:
            up = elements[e.parent]
            up.words, up.article_words, up.hints = up.words + e.words, up.article_words + e.article_words, up.hints + e.hints
    page = elements[0]
    state = []  # the outermost element whose name counts, or -1; marked; the nearest element around that speaks for the main text; how many do; the unit
    for i, e in enumerate(elements):
        below, marked, near, around, unit = state[e.parent] if i else (-1, False, -1, 0, -1)
        if below >= 0 and not elements[below].hidden and e.tag in HOME and not e.soft and (e.tag == "main" or 2 * e.words > elements[below].article_words):
            below = -1
        if (below < 0 or e.hidden) and (e.soft or e.hidden) and e.tag not in HOME:
            outside = page.hints - e.hints - around
            if near >= 0 and e.words < 0.8 * elements[near].words:
                outside += 1
            if 2 * e.words <= page.words or (outside and not e.hints):
                below = i
        marked = marked or e.marked
        if e.words and (e.marked or (e.tag in HOME and not e.soft)):
            near, around = i, around + 1
        unit = i if unit < 0 and e.tag in HOME else unit
        state.append((below, marked, near, around, unit))
    for b in blocks:
        below, b.marked, _, _, b.unit = state[b.parent]
        b.away = elements[b.parent].hard or below >= 0


def read_blocks(page: str) -> list[Block]:
    """The blocks of a page with text in them, in page order, character references decoded and white space made single."""
    blocks: list[Block] = []
    elements = [Element("", -1, False, False, False, False)]
    stack = [("", 0)]  # tag, number
    links, at, current = 0, 0, None
    where: dict[str, list[int]] = {}  # places of the open elements of each tag in the stack
    homes: list[int] = []

    def close(size: int) -> None:
        while len(stack) > size:
            tag, _ = stack.pop()
            where[tag].pop()
            if tag in HOME:
                homes.pop()

    def text(piece: str) -> None:
        nonlocal current
        if not piece:
            return
        if current is None:
            tag, number = stack[-1]
            current = Block(tag, number, len(stack), False, elements[number].home, False)
            blocks.append(current)
        current.parts.append(piece)
        if links:
            current.link_chars += len(piece.strip())

    for m in _TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag == "a":
            links = 0 if m[2] else 1
        if tag == "br":
            text(" ")
        if tag not in BLOCK:
            continue
        current, links = None, 0
        if m[2]:
            if where.get(tag) and (not homes or where[tag][-1] >= homes[-1] or tag in ("body", "html")):
                close(where[tag][-1])
            continue
        ends = ("p", *HEADINGS) if tag in HEADINGS else ("p",)
        if stack[-1][0] in ends or stack[-1][0] == tag and tag in ("li", "td", "th", "tr", "dt", "dd", "option"):
            close(len(stack) - 1)
        if tag in VOID:
            continue
        number = stack[-1][1]
        home = elements[number].home or tag in HOME
        hidden, soft, mark = _marks(tag, m[4], home)
        hard = elements[number].hard or tag in AWAY or (tag == "header" and not home)
        where.setdefault(tag, []).append(len(stack))
        if tag in HOME:
            homes.append(len(stack))
        stack.append((tag, len(elements)))
        elements.append(Element(tag, number, hard, soft or tag == "form", home, mark and tag not in HOME, hidden))
    text(page[at:])
    for b in blocks:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
    blocks = [b for b in blocks if b.text]
    _settle(elements, blocks)
    return blocks


def role_of_articles(blocks: list[Block]) -> str:
    """What ``article`` and ``main`` are on a page: ``"text"``, ``"teasers"`` beside a text that is in neither, or ``""``.

    They are the text if they have more words outside links than the rest of the page that is not away, and one of them has no
    fewer than the rest that a name marks as the article. Several ones of which none has half the words of the rest are teasers.
    """
    inside, rest, marked = {}, 0.0, 0.0
    for b in blocks:
        if b.away:
            continue
        if b.home:
            inside[b.unit] = inside.get(b.unit, 0.0) + b.words
        else:
            rest += b.words
            marked += b.words if b.marked else 0
    if not inside:
        return ""
    largest = max(inside.values())
    if sum(inside.values()) >= rest and largest >= marked:
        return "text"
    return "teasers" if len(inside) > 1 and 2 * largest < rest else ""


def content_gain(block: Block, role: str) -> int:
    """How much cheaper it is to call a block content than boilerplate; ``role`` is that of ``role_of_articles``."""
    words = block.text.count(" ") + 1
    linked = min(1.0, block.link_chars / max(1, len(block.text)))
    gain = min(words, 40) / 10 - 1 - 4 * linked + (0.5 if block.text[-1] in ".!?:;…\"'»”)" else 0)
    gain += 1 if block.tag in ("p", "blockquote", "pre") else 0.5 if block.tag in HEADINGS else -0.5 if block.tag in ("li", "td", "th") else 0
    if block.away:
        gain -= 40
    elif block.home and role:
        gain += 5 if role == "text" else -8
    elif block.marked or block.home:
        gain += 2
    if role == "text" and not block.home:
        gain -= 8
    return round(gain * UNIT)


def minimum_cut(gains: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes are on the side of the source in the smallest minimum cut, by blocking flows.

    A node with a positive gain hangs on the source with that capacity, one with a negative gain on the sink; edges are
    undirected and carry their weight either way.
    """
    n = len(gains)
    source, sink = n, n + 1
    to, room, out = [], [], [[] for _ in range(n + 2)]

    def add(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, gain in enumerate(gains):
        if gain > 0:
            add(source, i, gain, 0)
        elif gain < 0:
            add(i, sink, -gain, 0)
    for a, b, weight in edges:
        add(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, [source]
        for a in queue:
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        place, path, a = [0] * (n + 2), [], source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                full = next(k for k, e in enumerate(path) if not room[e])
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while place[a] < len(out[a]):
                e = out[a][place[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                place[a] += 1
            else:
                if a == source:
                    break
                a = to[path.pop() ^ 1]
                place[a] += 1
                continue
            path.append(e)
            a = to[e]


def main_text(page: str | None) -> str:
    """Content blocks of a page joined by an empty line; a null page, or one without content, gives the empty text."""
    blocks = read_blocks(page or "")
    if not blocks:
        return ""
    role = role_of_articles(blocks)
    gains = [content_gain(b, role) for b in blocks]
    if all(g > 0 for g in gains):
        return "\n\n".join(b.text for b in blocks)
    edges, last_of = [], {}
    for i, b in enumerate(blocks):
        if i:
            before = blocks[i - 1]
            steps = abs(b.depth - before.depth) + (0 if b.parent == before.parent else 1) + 2 * (b.home != before.home) + 2 * (b.away != before.away)
            edges.append((i - 1, i, round(1.5 * UNIT / (1 + steps))))
        if (k := last_of.get((b.parent, b.depth))) is not None and k != i - 1:
            edges.append((k, i, UNIT))
        last_of[b.parent, b.depth] = i
    kept = minimum_cut(gains, edges)
    return "\n\n".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def extract_text(page: Column) -> Column:
    """Main text of each page; never null."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], dtype=object)

    return extract(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages`` (``page_id``, ``url``, ``html``); ids may be null or repeat."""
    return pages.select("page_id", "url", extract_text(F.col("html")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
