"""Main text of web pages by composite text density.

Each node of a page's tree gets a density: characters per tag, lowered by the share of link
characters and link tags in it. Formatting inside a line is no tag of its own. The node whose
children's densities have the greatest sum holds the text. The least density on its path up to the
body is the threshold: every other subtree that reaches it is searched for its own node of
greatest sum. Of equal sums, a marked article or main part wins. If the body itself wins and one
block has ``MOSTLY`` all of its sum, that block is taken. The last heading of the first order
before the text belongs to it.

Elements that cannot be article text (scripts, styles, menus, page headers and footers, asides,
fields) are taken out before. Forms and blocks whose class or id names a menu, sidebar, advert,
notice or reader comments go too, as whole words that no other part denies (``no-comments``,
``has-sidebar``, ``ad-free``). That is a hint only: one with more than half of the page's text, few
of it links, stays unless it names an advert or comments, and so does any that nearly all text is in. A null page, or one
without text, gives empty text. Rows that repeat are extracted each on its own; the tree is walked
without recursion, so depth has no bound.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityviews.llm.common import by_bytes

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math meter "
    "output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset(
    "head script style title textarea noscript iframe xmp noembed noframes template svg canvas object "
    "audio video nav footer aside button select option optgroup datalist input dialog menu map".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar status".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo "
    "promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer masthead cookie "
    "cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
    "social share sharing related recommended comment comments respond disqus login search form "
    "pagination pager toolbar widget widgets skip".split())
HEADERS = frozenset("header topbar".split())
#: Hints that hold however much text is in the block.
SURE = frozenset(
    "comment comments respond disqus ad ads adv advert adverts advertisement advertising adsense sponsor "
    "sponsored promo promotion cookie cookies consent gdpr".split())
#: Parts of a class or id that deny the others, or only tell how a page is laid out.
DENIALS = frozenset(
    "no not non has have with without hide free less open closed enabled disabled on off layout theme".split())
KEPT = frozenset("html body article main".split())
TEXT_PARTS = frozenset("article main".split())
TEXT_WORDS = frozenset("article main entry post story content".split())
LINES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th".split())
MOSTLY = 0.8
#: A start tag of the key closes an open element of the value, up to a boundary.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
BOUNDS = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"},
    "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "thead": {"table"},
    "tbody": {"table"},
}
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table "
    "ul".split())
P_BOUNDS = frozenset("td th table button caption object html body".split())
#: Inline end tags don't reach over these.
WALLS = frozenset("td th table article section div body html ul ol li main".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[\s_\-]+|(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "up", "items", "drop", "hint", "link", "chars", "links", "tags", "link_tags", "density",
                 "total")

    def __init__(self, tag: str, up: Node | None, drop: bool = False, hint: frozenset | None = None):
        self.tag, self.up, self.drop, self.hint = tag, up, drop, hint
        self.link = tag == "a" or (up is not None and up.link)
        self.items: list[Node | str] = []


def parse(page: str) -> Node:
    """The tree of a page: elements, and text with its character references decoded."""
    top = at = Node("html", None)
    spot, size, lower = 0, len(page), None
    quotes = {'"': True, "'": True}  # whether any may be left to the right
    while spot < size:
        less = page.find("<", spot)
        if less < 0:
            less = size
        if less > spot and not at.drop:
            at.items.append(html.unescape(page[spot:less]))
        if less == size:
            break
        after = page[less + 1:less + 2]
        if after == "!" or after == "?":
            if page.startswith("<!--", less):
                end = page.find("-->", less + 4)
                spot = size if end < 0 else end + 3
            else:
                end = page.find(">", less)
                spot = size if end < 0 else end + 1
            continue
        ending = after == "/"
        found = NAME.match(page, less + 1 + ending)
        if not found:
            if ending:
                end = page.find(">", less)
                spot = size if end < 0 else end + 1
            else:
                if not at.drop:
                    at.items.append("<")
                spot = less + 1
            continue
        tag = found[0].lower()
        end = page.find(">", found.end())
        if end < 0:
            break  # a tag that never ends is no text
        inside = page[found.end():end]
        for q in ('"', "'"):
            while quotes[q] and inside.count(q) % 2 and (q == '"' or '"' not in inside):
                close = page.find(q, end + 1)
                more = page.find(">", close) if close >= 0 else -1
                if more < 0:
                    quotes[q] = False
                    break
                end, inside = more, page[found.end():more]
        spot = end + 1
        if ending:
            at = _ended(at, tag)
            continue
        at = _opened(at, tag, inside)
        if tag in RAW:
            if lower is None:
                lower = page.lower() if len(page.lower()) == size else page
            close = lower.find(f"</{tag}", spot)
            if close < 0:
                close = size
            if not at.drop:
                at.items.append(html.unescape(page[spot:close]))
            gt = page.find(">", close)
            spot = size if gt < 0 else gt + 1
            at = at.up or top
        elif tag in VOID or inside.endswith("/") and tag not in ENDS_P and tag not in INLINE:
            at = at.up or top
    return top


def _opened(at: Node, tag: str, attributes: str) -> Node:
    if tag in ("html", "body") and at.up is None and tag == "html":
        return at
    if tag in ENDS_P:
        at = _closed(at, {"p"}, P_BOUNDS)
    elif tag in CLOSES:
        at = _closed(at, CLOSES[tag], BOUNDS[tag])
    elif tag == "body":
        at = _closed(at, {"head"}, frozenset())
    drop = at.drop or tag in DROPPED or tag == "header" and at.tag in ("html", "body")
    node = Node(tag, at, drop, None if drop else _hint(at, tag, attributes))
    at.items.append(node)
    return node


def _closed(at: Node, tags, bounds) -> Node:
    """Where the next element goes once an open element of ``tags`` is closed."""
    out, look = at, at
    while look.up is not None and look.tag not in bounds:
        if look.tag in tags:
            out = look.up
        look = look.up
    return out


def _ended(at: Node, tag: str) -> Node:
    look = at
    while look.up is not None:
        if look.tag == tag:
            return look.up
        if tag in INLINE and look.tag in WALLS:
            return at
        look = look.up
    return at


def _hint(at: Node, tag: str, attributes: str) -> frozenset | None:
    """Words of the element that speak against it; None if there are none."""
    found = {"form"} if tag == "form" else set()
    if tag in KEPT or "=" not in attributes:
        return frozenset(found) or None
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        for name in html.unescape(a or b or c).split():
            words = {w.lower() for w in PART.split(name) if w}
            if key.lower() == "role":
                found |= words & ROLES
            elif not words & DENIALS:
                found |= words & HINTS
                if words & HEADERS and not words & TEXT_WORDS and not _in_text(at):
                    found |= words & HEADERS
    return frozenset(found) or None


def _in_text(at: Node | None) -> bool:
    while at is not None:
        if at.tag in TEXT_PARTS:
            return True
        at = at.up
    return False


def _kept(top: Node) -> list[Node]:
    """All nodes that are not dropped, parents first."""
    nodes = [top]
    for node in nodes:
        nodes.extend(x for x in node.items if isinstance(x, Node) and not x.drop)
    return nodes


def _count(nodes: list[Node]) -> None:
    """Characters and tags below each node, and those in links."""
    for node in reversed(nodes):
        node.chars = node.links = node.tags = node.link_tags = 0
        for x in node.items:
            if isinstance(x, str):
                n = len("".join(x.split()))
                node.chars += n
                node.links += n if node.link else 0
            elif not x.drop:
                node.chars += x.chars
                node.links += x.links
                node.tags += (x.tag == "a" or x.tag not in INLINE) + x.tags
                node.link_tags += x.link_tags + (x.tag == "a")


def _take_hints(top: Node) -> None:
    """Drop what hints speak against, unless the page's text is in it."""
    nodes = _kept(top)
    if not any(n.hint for n in nodes):
        return
    _count(nodes)
    inside: dict[int, Node] = {}  # hinted nodes that none is above
    for n in nodes:
        over = inside.get(id(n.up)) if n.up is not None else None
        if over is not None:
            inside[id(n)] = over
        elif n.hint and not (not n.hint & SURE and 2 * n.chars > top.chars and 2 * n.links < n.chars):
            inside[id(n)] = n
    outer = [n for n in nodes if inside.get(id(n)) is n]
    rest = top.chars - sum(n.chars for n in outer)
    largest = max(outer, key=lambda n: n.chars, default=None)
    if largest is not None and 20 * rest < top.chars and 2 * largest.links < largest.chars:
        outer.remove(largest)  # nearly all text is in what hints speak against
        largest.hint = None
        for n in outer:
            n.drop = True
        _take_hints(top)
        return
    for n in outer:
        n.drop = True


def _measured(top: Node) -> list[Node]:
    """All kept nodes, parents first, with their densities and the sums of their children's."""
    _take_hints(top)
    nodes = _kept(top)
    _count(nodes)
    whole = next((n for n in nodes if n.tag == "body"), top)
    ratio = whole.links / max(1, whole.chars)
    for node in nodes:
        node.density = _density(node, ratio)
    for node in reversed(nodes):
        node.total = sum(x.total if x.tag in INLINE else x.density
                         for x in node.items if isinstance(x, Node) and not x.drop)
    return nodes


def _density(node: Node, ratio: float) -> float:
    if not node.chars:
        return 0.0
    chars, links, tags, link_tags = node.chars, max(1, node.links), max(1, node.tags), max(1, node.link_tags)
    rest = max(1, node.chars - node.links)
    base = math.log(chars / rest * node.links + ratio * chars + math.e)
    weight = max(chars / links * tags / link_tags, 1.0 + 1e-9)
    return chars / tags * math.log(weight) / math.log(max(base, 1.0 + 1e-9))


def main_text(page: str | None) -> str:
    if not page:
        return ""
    top = parse(page)
    nodes = _measured(top)
    best = max((n for n in nodes if n.tag not in INLINE), key=lambda n: (n.total, n.tag in TEXT_PARTS))
    while best.tag in ("html", "body"):
        heavy = [x for x in best.items if isinstance(x, Node) and not x.drop
                 and x.tag not in INLINE and x.tag not in LINES and x.density >= MOSTLY * best.total > 0]
        if not heavy:
            break
        best = heavy[0]
    look, least = best, best.density
    while look is not None and look.tag != "html":
        least = min(least, look.density)
        look = look.up
    chosen = _marked(nodes, least) | {id(best)}
    heading = _heading(top, best)
    if heading is not None:
        chosen.add(id(heading))
    out: list[str] = []
    stack: list = [(top, False)]
    while stack:
        x, kept = stack.pop()
        if isinstance(x, str):
            if kept:
                out.append(x)
            continue
        if x is None or x.drop:
            out.append(" ")
            continue
        kept = kept or id(x) in chosen
        if x.tag not in INLINE:
            out.append(" ")
            stack.append((None, False))
        stack.extend((y, kept) for y in reversed(x.items))
    return " ".join("".join(out).split())


def _marked(nodes: list[Node], least: float) -> set[int]:
    """In each subtree that reaches the threshold, its node of greatest sum."""
    most: dict[int, Node] = {}
    for node in reversed(nodes):
        best = node
        for x in node.items:
            if isinstance(x, Node) and not x.drop and most[id(x)].total > best.total:
                best = most[id(x)]
        most[id(node)] = best
    return {id(most[id(n)]) for n in nodes if n.tag != "html" and n.chars and n.density >= least}


def _heading(top: Node, best: Node) -> Node | None:
    """The last h1 that comes before ``best`` in the page."""
    found, stack = None, [top]
    while stack:
        node = stack.pop()
        if node is best:
            return found
        if node.tag == "h1":
            found = node
        stack.extend(x for x in reversed(node.items) if isinstance(x, Node) and not x.drop)
    return None


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, main ``text`` and its ``n_chars`` of each row of ``pages``."""

    def read(batches):
        for batch in by_bytes(batches, "html"):
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html")
    ).mapInArrow(read, "page_id bigint, url string, text string, n_chars bigint")
