"""Main text of web pages by scoring the element tree.

The page is read into a tree that tolerates missing end tags. Every paragraph
gives points for itself, its length and its commas, in full to its parent, half
to the next ancestor and less further up; an element's score is discounted by
the share of its text that lies in links. The container with the best score and
those siblings that are text as well are kept; junk elements inside are left out.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from braidwork.llm.batches import small_batches

# A quote opens a value only behind "=", and only if its partner follows; a tag also ends where the
# next one begins. Possessive parts never go back, so a page is read in one pass.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|(?=<)|\Z)",
    re.S,
)
_HINT = re.compile(r"""\b(?:class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I | re.S)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp svg select".split())
# Annotations repeat a formula in another notation.
SKIP = RAW | frozenset("head nav footer aside form button dialog menu canvas audio video map fieldset annotation annotation-xml".split())
BLOCK = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th"
    " blockquote pre figure figcaption header hr address details summary center caption".split()
)
PARAGRAPH = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6".split())
# A start tag of the key ends open elements of the values, within the nearest container.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_BARRIER = frozenset("body main article section div ul ol dl table blockquote td th html header".split())
# Parts of names (cut at "-" and "_") of what is no article, and parts that say nothing by themselves.
_JUNK = re.compile(
    r"(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|notice\w*|gdpr|popup\w*|modal|overlay"
    r"|newsletter\w*|subscri\w+|signup|sidebar\w*|side|widget\w*|related\w*|recommend\w*|menu\w*|nav\w*|breadcrumbs?"
    r"|pagination|pager|toolbar|footer\w*|masthead|topbar|share\w*|sharing|social\w*|comment\w*|disqus|replies|respond"
    r"|login|search\w*|skip\w*|alert|hidden|complementary|contentinfo)\Z",
    re.I,
)
_PLAIN = re.compile(
    r"(?:\d*|area|articles?|bars?|block|bottom|box|buttons?|card|center|col|column|container|content|feed|form|global|group"
    r"|head|header|icons?|inner|item|items|js|left|link|links|list|main|media|module|news|nojs|outer|page|panel|posts?|primary"
    r"|region|reader|right|secondary|section|site|slot|stories|text|title|to|top|unit|up|user|us|wrap|wrapper|zone)\Z",
    re.I,
)
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
# A name of which only a part fits is believed where this share of the text is links.
MAYBE_LINKS = 1 / 3
_P = re.compile(r"<p[\s>]", re.I)
_HEADER = re.compile(r"(?:^|\s)(?:(?:site|page|global|main|top)[-_]?)?header(?:$|\s)", re.I)
_GOOD = {"article": 25.0, "main": 20.0, "section": 3.0, "div": 2.0, "body": -5.0, "li": -3.0, "ul": -3.0, "ol": -3.0}


class Node:
    __slots__ = ("tag", "parent", "items", "junk", "maybe", "points", "open")

    def __init__(self, tag: str, parent: "Node | None", junk: bool) -> None:
        self.tag, self.parent, self.junk, self.maybe = tag, parent, junk, False
        # Open elements by tag, since the nearest container on.
        self.open: dict[str, int] = {}
        self.items: list[Node | str] = []
        self.points = 0.0


class _Open:
    """The path of open elements, with counts by tag so that no search for a missing one walks it."""

    def __init__(self, root: Node) -> None:
        self.at, self.counts, self.containers = root, {root.tag: 1}, [root]

    def enter(self, node: Node) -> None:
        self.at = node
        self.counts[node.tag] = self.counts.get(node.tag, 0) + 1
        if node.tag in _BARRIER:
            self.containers.append(node)
        else:
            near = self.containers[-1].open
            near[node.tag] = near.get(node.tag, 0) + 1

    def leave(self, until: Node) -> None:
        """Close the open elements below ``until``."""
        while self.at is not until:
            tag = self.at.tag
            self.counts[tag] -= 1
            if tag in _BARRIER:
                self.containers.pop()
            else:
                self.containers[-1].open[tag] -= 1
            self.at = self.at.parent

    def has(self, tag: str) -> bool:
        return self.counts.get(tag, 0) > 0

    def near(self, tag: str) -> bool:
        """Is one open within the nearest container?"""
        return self.containers[-1].tag == tag or self.containers[-1].open.get(tag, 0) > 0


def parse(page: str, hints: bool = True) -> Node:
    """The element tree; texts are kept undecoded. Without ``hints`` only tags make junk."""
    root = Node("html", None, False)
    path = _Open(root)
    place, end = 0, len(page)
    hinted: set[int] = set()
    # Tags whose end tag does not come any more.
    endless: set[str] = set()
    article_seen = body_seen = False
    while place < end:
        m = _MARKUP.search(page, place)
        if m is None:
            path.at.items.append(page[place:])
            break
        if m.start() > place:
            path.at.items.append(page[place : m.start()])
        place = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            # Block elements end wherever they are open, others within their container only.
            if path.has(tag) if tag in BLOCK else path.near(tag):
                node = path.at
                while node.tag != tag:
                    node = node.parent
                if node.parent is not None:
                    path.leave(node.parent)
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                path.at.items.append(" " if tag == "br" else Node("hr", path.at, False))
            continue
        if tag in RAW:
            close = None if tag in endless else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, place)
            if close is None:
                endless.add(tag)
            place = close.end() if close else (end if tag in ("script", "style", "textarea", "title") else place)
            continue
        if tag in BLOCK and path.near("p"):
            node = path.at
            while node.tag != "p":
                node = node.parent
            path.leave(node.parent)
        if tag in _ENDS and any(path.near(x) or (x in _BARRIER and path.has(x)) for x in _ENDS[tag]):
            node, outer = path.at, None
            while node is not None and (node.tag not in _BARRIER or node.tag in _ENDS[tag]):
                if node.tag in _ENDS[tag]:
                    outer = node.parent
                node = node.parent
            if outer is not None:
                path.leave(outer)
        if tag in ("html", "body"):
            if tag == "html" or body_seen:
                continue
            body_seen = path.at is root
        junk, maybe, in_article = tag in SKIP, False, path.has("article")
        made_by_hint = False
        if not junk and hints and m[3].strip() and tag not in ("body", "article", "main"):
            values = [_value(h) for h in _HINT.findall(m[3])]
            says = [_says(v) for v in values]
            junk, maybe = 2 in says, 1 in says
            if not junk and not in_article:
                junk = any(_HEADER.search(v) for v in values)
            made_by_hint = junk or maybe
        if not junk and tag == "header" and not in_article:
            junk = True
        node = Node(tag, path.at, junk)
        node.maybe = maybe and not junk
        if made_by_hint:
            hinted.add(id(node))
        if tag in ("article", "main"):
            # The first article tells that what holds it is a frame, whatever its name says.
            up = None if article_seen else path.at
            while up is not None:
                if id(up) in hinted:
                    up.junk = up.maybe = False
                up = up.parent
            article_seen = True
        path.at.items.append(node)
        if not m[3].endswith("/"):
            path.enter(node)
    _settle(root)
    return root


def _says(value: str) -> int:
    """Does a name speak of junk: 2 surely, 1 in part, 0 not at all."""
    if value == "hidden" or _UNSEEN.search(value):
        return 2
    found = 0
    for name in value.split():
        parts = [p for p in re.split(r"[-_]+", name) if p]
        bad = [bool(_JUNK.match(p)) for p in parts]
        if any(bad):
            whole = all(b or _PLAIN.match(p) for b, p in zip(bad, parts))
            found = max(found, 2 if whole else 1)
    return found


def _settle(root: Node) -> None:
    """Elements whose names speak of junk in part only are junk where much of their text is links."""
    order, todo = [], [(root, False)]
    while todo:
        node, link = todo.pop()
        order.append((node, link))
        todo.extend((x, link or x.tag == "a") for x in node.items if isinstance(x, Node) and not x.junk)
    sizes: dict[int, tuple[int, int]] = {}
    for node, link in reversed(order):
        n = sum(len(x.strip()) for x in node.items if isinstance(x, str))
        links = n if link else 0
        for x in node.items:
            if isinstance(x, Node) and not x.junk:
                n, links = n + sizes[id(x)][0], links + sizes[id(x)][1]
        sizes[id(node)] = n, links
        node.junk = node.junk or (node.maybe and links >= MAYBE_LINKS * n)


def _value(attribute: str) -> str:
    name, _, value = attribute.partition("=")
    name, value = name.strip().lower(), value.strip().strip("\"'")
    if name == "style":
        return value if "none" in value else ""
    if name == "aria-hidden":
        return "hidden" if value == "true" else ""
    return "hidden" if name == "hidden" else value


def blocks(node: Node) -> list[str]:
    """The texts of the blocks below ``node`` in page order, decoded and with single blanks."""
    out: list[str] = []
    run: list[str] = []

    def cut() -> None:
        text = "".join(run)
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            out.append(text)
        run.clear()

    todo: list[Node | str | None] = [node]
    while todo:
        item = todo.pop()
        if item is None:
            cut()
        elif isinstance(item, str):
            run.append(item)
        elif not item.junk:
            if item.tag in BLOCK:
                cut()
                todo.append(None)
            todo.extend(reversed(item.items))
    cut()
    return out


def _measure(node: Node) -> tuple[list[tuple[Node, int, int]], dict[int, list[int]]]:
    """Paragraphs with length and commas; per element its text and link lengths."""
    sizes: dict[int, list[int]] = {}
    paragraphs: list[tuple[Node, int, int]] = []
    order: list[tuple[Node, bool]] = []
    todo = [(node, False)]
    while todo:
        item, link = todo.pop()
        order.append((item, link))
        todo.extend((x, link or x.tag == "a") for x in item.items if isinstance(x, Node) and not x.junk)
    for item, link in reversed(order):
        own = [x for x in item.items if isinstance(x, str)]
        length = sum(len(x.strip()) for x in own)
        commas = sum(x.count(",") + x.count("，") + x.count("、") for x in own)
        inside = [0, 0, 0]
        block_below = False
        for x in item.items:
            if isinstance(x, Node) and not x.junk:
                n, links, c = sizes[id(x)]
                inside = [inside[0] + n, inside[1] + links, inside[2] + c]
                block_below |= x.tag in BLOCK
        sizes[id(item)] = [length + inside[0], inside[1] + (length if link else 0), commas + inside[2]]
        if item.tag in PARAGRAPH and not block_below:
            paragraphs.append((item, length + inside[0], commas + inside[2]))
        elif item.tag in BLOCK and length:
            paragraphs.append((item, length, commas))
    return paragraphs, sizes


def main_text(page: str) -> str:
    """The blocks of the article of a page, joined by one blank; empty if there is none."""
    found = _best_text(parse(page))
    if found or len(_P.findall(page)) < 2:
        return found
    # Paragraphs, but all in elements whose names look like junk: go by the tags alone.
    return _best_text(parse(page, hints=False))


def _best_text(root: Node) -> str:
    paragraphs, sizes = _measure(root)
    candidates: dict[int, Node] = {}

    def give(node: Node | None, points: float) -> None:
        if node is not None:
            if id(node) not in candidates:
                candidates[id(node)] = node
                node.points = _GOOD.get(node.tag, 0.0)
            node.points += points

    for node, length, commas in paragraphs:
        n, links, _ = sizes[id(node)]
        points = (1 + commas + min(length / 100, 3)) * (1 - links / n if n else 0)
        if length <= 0:
            continue
        parent = node.parent if node.tag in PARAGRAPH and node.parent is not None else node
        give(parent, points)
        up, share = parent.parent, 2
        while up is not None and share < 12:
            give(up, points / share)
            up, share = up.parent, share * 2 if share == 2 else share + 2
    if not candidates:
        return ""

    def score(node: Node) -> float:
        n, links, _ = sizes[id(node)]
        return node.points * (1 - links / n if n else 0)

    best = max(candidates.values(), key=score)
    node = best
    while node.parent is not None:
        node = node.parent
        if node.tag in ("article", "main"):
            best = node
    top = score(best)
    if best.parent is None or best.tag in ("article", "main", "body"):
        kept = [best] if best.tag != "article" else _siblings(best, top, sizes, score, articles=True)
    else:
        kept = _siblings(best, top, sizes, score, articles=False)
    return " ".join(text for node in kept for text in blocks(node))


def _siblings(best: Node, top: float, sizes: dict, score, *, articles: bool) -> list[Node]:  # noqa: ANN001
    """``best`` and those of its siblings that are text: scored well, or paragraphs and headings with few links."""
    out = []
    for x in best.parent.items if best.parent is not None else [best]:
        if not isinstance(x, Node) or x.junk:
            continue
        n, links, _ = sizes[id(x)]
        few = n > 0 and links / n < 0.25
        if x is best:
            out.append(x)
        elif articles:
            if x.tag == "article" and few and score(x) >= max(10.0, 0.6 * top):
                out.append(x)
        elif few and (x.tag in PARAGRAPH or score(x) >= max(10.0, 0.2 * top)):
            out.append(x)
    return out


def extract_pages(pages: DataFrame, *, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text in ``out``; null or empty html gives an empty text.

    The whole html is read. Rows pass one by one with all their other columns, so
    repeated rows and clashing ids do not matter; a column named ``out`` is replaced.
    """
    base = pages.drop(out) if out != html_col else pages
    names, at = base.columns, base.columns.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) if page else "" for page in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, out])

    return small_batches(base).mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(out, T.StringType())]))
