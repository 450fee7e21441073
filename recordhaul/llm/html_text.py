"""Main text of web pages by tree scoring.

A page is parsed leniently into a tree, without what never is an article (scripts, menus, hidden elements
and the like). What seems to lie outside the article by the words of class and id, or is a form, goes only
when the tree is whole, as an article may stand in it. Paragraphs then pass points to their
ancestors, one and more for each comma and each hundred code points, less the farther off these are. An
element's points are discounted by the share of its text that stands in links. The best container is
widened to the ``article`` or ``main`` element around it, and siblings that score well too, are
running text or are its headings, are kept with it.

Every page is worked on in the task that reads it; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset(
    "area base br col embed frame hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open paragraph.
ENDS_P = BLOCKS - frozenset("body caption html legend tbody td tfoot th thead tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: For elements whose end tag may be missing: which open ones a new one ends, and within what.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
P_SCOPE = frozenset("table td th caption object button html body".split())

#: Elements and roles that hold no article text.
DROPPED = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form frame frameset head iframe input "
    "label map menu nav noframes noscript object optgroup option output picture progress script "
    "select style svg template textarea title video".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "status toolbar".split()
)
#: Words of class or id that tell what surrounds an article.
OUTSIDE = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner billboard breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies copyright disclaimer discussion disqus "
    "feedback footer gdpr login masthead menu menubar modal nav navbar navigation navi newsletter notice "
    "notices notification overlay pager pagination paywall popup promo promoted promotion recommended related "
    "replies reply respond responses share sharing sidebar signin signup skip social sponsor sponsored subscribe "
    "subscription supplemental tags toolbar topbar widget widgets".split()
)
#: Those of them of which an element may have one and hold the article all the same.
UNSURE = OUTSIDE - frozenset(
    "breadcrumb breadcrumbs comment comments commentlist consent cookie cookies discussion disqus feedback footer "
    "gdpr menu menubar nav navbar navigation navi newsletter pager pagination replies reply respond responses "
    "sidebar".split()
)
HEADER = frozenset("header head".split())
INSIDE = frozenset("article body content entry main post story text".split())
#: Before a word of ``OUTSIDE`` these tell that the element only lies beside it.
BESIDE = frozenset("has no with without hide".split())

_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
#: A tag that the end of the page cuts off.
_CUT_OFF = re.compile(r"<[A-Za-z/!?][^<>]*\Z")

#: Elements whose end tag may be missing, which then ends with the element around it.
UNENDED = frozenset("p li dt dd tr td th option".split())
#: Elements that are passed over only if their end tag comes.
ENDED = frozenset("button label map output".split())
#: Share of a text in links from which it is a list of them.
LINKS = 0.3

#: Levels over which points are passed.
LEVELS = 5
LEAST_PARAGRAPH = 25
#: End tags that are missed one by one; what a further one lacks stays passed over.
TRIES = 8


class Node:
    __slots__ = ("tag", "parent", "children", "names", "score", "length", "linked", "beside", "unsure")

    def __init__(self, tag: str, parent: Node | None, names: tuple[str, ...] = ()):
        self.tag, self.parent, self.names = tag, parent, names
        self.children: list[Node | str] = []
        self.score, self.length, self.linked = 0.0, 0, 0
        #: Whether it seems to lie outside the article.
        self.beside = False
        #: Whether that is to be settled by its text.
        self.unsure = False

    def inside(self, tags) -> bool:
        node = self
        while node is not None:
            if node.tag in tags:
                return True
            node = node.parent
        return False


def _names(attributes: dict[str, str | None]) -> tuple[str, ...]:
    words = f"{attributes.get('class') or ''} {attributes.get('id') or ''}"
    return tuple(w.lower() for w in _NAME.findall(words))


def _outside(tag: str, attributes: dict[str, str | None]) -> bool:
    """Whether an element surely holds no article text."""
    if tag in ("html", "body"):
        return False
    if tag in DROPPED - {"form"} or (attributes.get("role") or "").lower() in ROLES - {"form"}:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    return bool(_HIDDEN.search(attributes.get("style") or ""))


def _beside(tag: str, attributes: dict[str, str | None], names: tuple[str, ...], parent: Node) -> bool:
    """Whether an element seems to hold something else than article text."""
    if tag in ("html", "body"):
        return False
    if tag == "form" or (attributes.get("role") or "").lower() == "form":
        return True
    if tag == "main" or not (names or tag == "header"):
        return False
    for before, name in zip(("", *names), names, strict=False):
        if name in OUTSIDE and before not in BESIDE:
            return True
    if tag == "header" or HEADER & set(names):
        return not (INSIDE & set(names) or parent.inside(("article", "main")))
    return False


def _unsure(names: tuple[str, ...], parent: Node) -> bool:
    """Whether an element that seems to hold something else may hold the article, or a part of it."""
    told = OUTSIDE & set(names)
    return bool(told) and told <= UNSURE and (bool(INSIDE & set(names)) or parent.inside(("article", "main")))


class TreeBuilder(HTMLParser):
    """Elements with their text; what never is an article is passed over with all it holds.

    ``unended`` are the numbers of elements that would be passed over but whose end tag does not come; their tags
    are left out instead.
    """

    def __init__(self, unended: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.unended, self.number = unended, 0
        #: Whether an element that is passed over only with its end tag has swallowed text.
        self.lost = False
        self.root = Node("#root", None)
        self.open = self.root
        #: Tags open below an element that is passed over, that element first.
        self.passed: list[str] = []

    def handle_starttag(self, tag, attrs):
        if self.passed:
            if tag in ENDS_P:
                self._end_passed({"p"}, P_SCOPE)
            if tag in IMPLIED:
                self._end_passed(*IMPLIED[tag])
        if self.passed:
            if tag not in VOID:
                self.passed.append(tag)
            return
        if tag in ENDS_P:
            self._end({"p"}, P_SCOPE)
        if tag in IMPLIED:
            ended, scope = IMPLIED[tag]
            while self._end(ended, scope):
                pass
        attributes = dict(attrs)
        names = _names(attributes)
        beside = _beside(tag, attributes, names, self.open)
        outside = _outside(tag, attributes)
        if outside and tag in ENDED:
            self.number += 1
            if self.number in self.unended:
                return
        if outside or (beside and tag in VOID):
            if tag not in VOID:
                self.passed.append(tag)
            if tag in BLOCKS:
                self.open.children.append(Node(tag, self.open))
            return
        node = Node(tag, self.open, names)
        node.beside = beside
        node.unsure = beside and _unsure(names, self.open)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        # A slash ends void elements only; in others, as in browsers, it means nothing.

    def handle_endtag(self, tag):
        if self.passed:
            if tag in self.passed:
                del self.passed[len(self.passed) - 1 - self.passed[::-1].index(tag) :]
            elif tag in ("body", "html") or (
                (tag in ("article", "main") or self.passed[0] in UNENDED) and self.open.inside((tag,))
            ):
                self.lost = self.passed[0] in ENDED
                self.passed.clear()  # its own end tag is missing
                self._end({tag}, ())
            return
        self._end({tag}, () if tag in BLOCKS else BLOCKS - {tag, "p"})

    def handle_data(self, data):
        if not self.passed:
            self.open.children.append(data)

    def _end_passed(self, tags, scope) -> None:
        """As ``_end``, among the elements that are passed over."""
        for n in range(len(self.passed) - 1, -1, -1):
            if self.passed[n] in tags:
                del self.passed[n:]
                return
            if self.passed[n] in scope:
                return

    def _end(self, tags, scope) -> bool:
        """Closes the innermost open element of ``tags``, unless one of ``scope`` lies between."""
        node = self.open
        while node.parent is not None:
            if node.tag in tags:
                self.open = node.parent
                return True
            if node.tag in scope:
                return False
            node = node.parent
        return False


def _in_order(root: Node) -> list[Node]:
    """Every element, each before those it holds."""
    out, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        out.append(node)
        waiting.extend(child for child in node.children[::-1] if isinstance(child, Node))
    return out


def _measure(nodes: list[Node]) -> None:
    """Lengths of text, and of text in links, of every element."""
    for node in nodes[::-1]:
        node.length = node.linked = 0
        for child in node.children:
            if isinstance(child, str):
                node.length += len(_SPACE.sub(" ", child.strip()))
            else:
                node.length += child.length
                node.linked += child.length if child.tag == "a" else child.linked


def _density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def _own_text(node: Node) -> str:
    """The text of a block that stands in no block within it."""
    out, waiting = [], [node]
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            out.append(item)
        elif item is node or item.tag not in BLOCKS:
            waiting.extend(item.children[::-1])
    return _SPACE.sub(" ", "".join(out)).strip()


def _points(node: Node) -> float:
    """What a paragraph passes to its ancestors."""
    if node.tag not in BLOCKS or node.tag in HEADINGS:
        return 0.0
    text = _own_text(node)
    if len(text) < LEAST_PARAGRAPH:
        return 0.0
    return (1 + text.count(",") + len(text) / 100) * (1 - _density(node))


def _give_points(nodes: list[Node]) -> None:
    for node in nodes:
        points = _points(node)
        if not points:
            continue
        holder = node.parent if node.tag in ("p", "pre", "blockquote", "li", "td", "dd") else node
        for level in range(1, LEVELS + 1):
            if holder is None or holder.parent is None:
                break
            holder.score += points / level
            holder = holder.parent


def _prune(nodes: list[Node]) -> list[Node]:
    """The elements without those that seem to lie outside the article, unless it stands in them.

    It does if they hold the ``main`` element, or an ``article`` where none stands outside of such
    elements; or the larger share of the page's points, if they are a form, hold the title ``h1`` or are
    not sure; or any points and few links, if they are not sure and within the article.
    """
    if not any(node.beside for node in nodes):
        return nodes
    _measure(nodes)
    points = {}
    holds: dict[int, set[str]] = {}
    free = set()  # elements around which nothing seems to lie outside
    for node in nodes:
        if not node.beside and (node.parent is None or id(node.parent) in free):
            free.add(id(node))
    for node in nodes[::-1]:
        below = [child for child in node.children if isinstance(child, Node)]
        points[id(node)] = _points(node) + sum(points[id(child)] for child in below)
        own = {node.tag} & {"main", "article", "h1"}
        holds[id(node)] = own.union(*(holds[id(child)] for child in below))
    articles = any(n.tag in ("article", "main") and id(n) in free and points[id(n)] for n in nodes)
    total = points[id(nodes[0])]
    for node in nodes:
        if not node.beside:
            continue
        held = holds[id(node)]
        around = not articles and "article" in held and points[id(node)] > 0
        titled = not articles and (node.tag == "form" or "h1" in held)
        most = 2 * points[id(node)] > total
        if "main" in held or around or (titled and most):
            continue
        if node.unsure and _density(node) < LINKS:
            if most or (points[id(node)] > 0 and node.parent.inside(("article", "main"))):
                continue
        node.children = []
        if node.tag not in BLOCKS:
            node.parent.children = [child for child in node.parent.children if child is not node]
    return _in_order(nodes[0])


def _container(nodes: list[Node]) -> list[Node]:
    """The best container and the siblings that belong to it, in page order."""
    _measure(nodes)
    _give_points(nodes)
    worth = {id(n): n.score * (1 - _density(n)) for n in nodes}
    best = max(nodes, key=lambda n: worth[id(n)])
    if not worth[id(best)]:
        whole = [n for n in nodes if n.tag in ("article", "main")] or [n for n in nodes if n.tag == "body"]
        return whole[:1] or nodes[:1]
    around = best
    while around is not None and around.tag not in ("article", "main"):
        around = around.parent
    if around is not None:
        best = around
    parent = best.parent
    kept = []
    for node in parent.children if parent is not None else [best]:
        if node is best:
            kept.append(node)
        elif isinstance(node, Node) and node.length:
            good = worth[id(node)] >= 0.2 * worth[id(best)]
            running = node.tag in ("p", "pre", "blockquote") and _density(node) < 0.25
            heading = node.tag in HEADINGS and _density(node) < 0.5 and best.tag not in ("article", "main")
            if good or running or heading:
                kept.append(node)
    return kept


def _blocks(root: Node) -> Iterator[str]:
    """The text of each block below an element, in page order."""
    held: list[str] = []
    waiting: list[Node | str | None] = [root]
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            held.append(item)
            continue
        if item is None or item.tag in BLOCKS:
            if text := _SPACE.sub(" ", "".join(held)).strip():
                yield text
            held = []
        elif item.tag == "br":
            held.append(" ")
        if item is not None:
            if item.tag in BLOCKS:
                waiting.append(None)
            waiting.extend(item.children[::-1])
    if text := _SPACE.sub(" ", "".join(held)).strip():
        yield text


def main_text(html: str | None) -> str:
    """The article of a page: its blocks joined by line feeds; empty for a null or empty page."""
    if not html:
        return ""
    page, unended = _CUT_OFF.sub("", html), frozenset()
    while True:
        builder = TreeBuilder(unended)
        builder.feed(page)
        builder.close()
        swallowed = builder.lost or (builder.passed and builder.passed[0] in ENDED)
        if not swallowed or len(unended) == TRIES:
            break
        unended |= {builder.number}
    kept = _container(_prune(_in_order(builder.root)))
    return "\n".join(text for node in kept for text in _blocks(node))


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) for every page.

    Null and empty pages have empty text; so has a page of nothing but surroundings. Text without any
    markup is one block. Repeated rows give equal rows, an empty table none, and very long pages are taken
    whole. Other columns are not looked at.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    source = pages.select(F.col("page_id").cast("long"), "url", "html")
    return source.mapInArrow(make, "page_id long, url string, text string, n_chars long")
