"""Main-text extraction from raw HTML by tree scoring.

A page is parsed into a tree of elements (implied end tags and stray tags are
handled the way browsers do). Boilerplate subtrees are cut: page furniture by
element, and containers whose class or id names it, however long they are. A name
is read word by word: it is furniture if one word is and the others only say where
or of what kind ("comment-list", "site-notice", "related-articles"); names that mean
a part of an article as often ("header", "widget") cut only what stands outside the
article, or is no prose. Each remaining paragraph-like block then earns points for its
length and its commas and passes them to its ancestors - all to the nearest
container, half to the next, a quarter, ... further up - and a container's points are
discounted by the share of its text that lies in links. The best container is kept, with
those siblings that are hardly linked. Inside the kept nodes the text is read off in
page order.

Parsing and scoring take time in proportion to the page, however it is nested. Each
page is one row of an Arrow batch; no exchange is needed, and a page is the unit of
memory.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MENU_LIKE = frozenset("ul ol dl div".split())
MENU_LABEL = 25  # characters of a menu's links on average; longer ones are titles, as in a list of sources
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CUT = frozenset("""head title script style noscript template nav header footer aside form button select textarea
    input fieldset iframe object embed svg canvas annotation annotation-xml video audio dialog menu datalist""".split())
BLOCK = frozenset("""address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6
    hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul caption""".split())
PARAGRAPH = frozenset("p pre blockquote td li dd h1 h2 h3 h4 h5 h6 figcaption div section article main body html".split())
CONTAINER = frozenset("body div section article main td center blockquote table tbody tr ul ol dl details figure html".split())
# an opening tag of the key ends an open element of the values, up to the nearest scope
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
        "tfoot": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
         "th": {"tr", "table"}, "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}, "body": {"html"}}
ENDS_P = BLOCK | {"form", "nav", "header", "footer", "aside", "fieldset", "menu", "dialog"}
# class and id words that name page furniture
FURNITURE = frozenset("""ad ads advert adverts advertisement advertisements adbox adslot advertising banner sponsor sponsored promo
    promos promoted promotion nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside rail footer foot
    masthead topbar toolbar header comment comments comentario comentarios commentlist disqus discussion reply replies respond
    responses cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter newsletters subscribe
    subscription signup login share sharing social related recommended recommendation recommendations pager pagination paging
    tags widget widgets skip skiplink""".split())
# of these, the words that may also name a part of the article
AMBIGUOUS = frozenset("side head header foot discussion promotion subscription rail skip widget widgets".split())
# words that say where a box is or of what kind, not what it holds
PLACES = frozenset("""site page global top bottom left right upper lower main first last primary secondary user users reader readers
    visitor box block area region section container wrapper wrap inner outer list item items group panel pane bar link links
    body text content thread form button buttons title heading more new latest""".split())
# after "related" and the like: what is related lies elsewhere
ELSEWHERE = frozenset("article articles post posts story stories news entries reading videos pages topics products".split())
POINTERS = frozenset("related recommended recommendation recommendations promoted sponsored share sharing social".split())
OF_ARTICLE = frozenset("article post entry story".split())  # "article-header", "post-comments"
MODIFIERS = frozenset("has no with without is not hide show".split())  # "has-sidebar" is no sidebar
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p blockquote pre main article".split())
NEVER_BY_NAME = HEADINGS | frozenset("html body article main p pre blockquote".split())
COMMENT = frozenset("comment comments comentario comentarios reply replies response responses".split())
COMMENT_PARTS = COMMENT | frozenset("body content item text list thread user reader box section area depth id li wp even odd".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "score", "passed", "chars", "linked", "links", "prose", "mains", "article",
                 "inside", "doubtful")

    def __init__(self, tag: str, attrs: dict, parent):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list = []  # Node or str
        self.score = self.passed = 0.0
        self.chars = self.linked = self.links = self.prose = self.mains = 0
        self.doubtful = False
        # the nearest article around it, and whether it lies in an article or main
        self.article = None if parent is None else parent if parent.tag == "article" else parent.article
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))


# one markup token; quoted attribute values may hold ">"; possessive, so no input makes it backtrack
TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)
    |<(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=|["'])*+)(?:>|\Z)
    |</[^>a-zA-Z][^>]*+(?:>|\Z)|</>""", re.S | re.X)
ATTR = re.compile(r"""([^\s=/"'>][^\s=/>]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())  # no markup inside


class TreeBuilder:
    """Lenient tree: void elements, implied ends of p, li, dt, dd, rows, cells and options."""

    def __init__(self):
        self.root = self.at = Node("html", {}, None)
        self.path = [self.root]  # the open elements
        self.open: dict[str, list[int]] = {"html": [0]}  # their places in the path, by tag
        self.containers = [0]

    def feed(self, html: str) -> None:
        pos, n = 0, len(html)
        while pos < n:
            m = TOKEN.search(html, pos)
            if m is None:
                break
            if m.start() > pos:
                self.text(html[pos:m.start()])
            pos = m.end()
            if m["start"]:
                tag = m["start"].lower()
                self.start(tag, m["attrs"])
                if tag in RAW:
                    close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, pos)
                    pos = close.start() if close else n
            elif m["end"]:
                self.end(m["end"].lower())
        if pos < n:
            self.text(html[pos:])

    def text(self, data: str) -> None:
        self.at.children.append(unescape(data) if "&" in data else data)

    def start(self, tag: str, attrs: str) -> None:
        if tag == "html":
            return
        if tag in ENDS_P and self.open.get("p"):
            self._close_open(("p",), SCOPE_OF_P)
        if tag in ENDS:
            self._close_open(ENDS[tag], SCOPE[tag])
        found: dict[str, str] = {}
        if attrs and not attrs.isspace():
            for name, a, b, c in ATTR.findall(attrs):
                found.setdefault(name.lower(), unescape(a or b or c))
        node = Node(tag, found, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.open.setdefault(tag, []).append(len(self.path))
            if tag in CONTAINER:
                self.containers.append(len(self.path))
            self.path.append(node)
            self.at = node

    def _cut_back(self, to: int) -> None:
        """Close all open elements from place ``to`` on; each is closed once."""
        while len(self.path) > to:
            tag = self.path.pop().tag
            self.open[tag].pop()
            if tag in CONTAINER:
                self.containers.pop()
        self.at = self.path[-1]

    def _innermost(self, tags) -> int:
        """Place of the innermost open element of ``tags``; 0 if there is none but the root."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def _close_open(self, tags, scope):
        """End the outermost of the open ``tags`` that no ``scope`` element shields."""
        if not any(self.open.get(t) for t in tags):
            return
        shield = self._innermost(scope)
        first = [places[k] for t in tags if (places := self.open.get(t)) and (k := bisect_right(places, shield)) < len(places)]
        if first:
            self._cut_back(min(first))

    def end(self, tag: str) -> None:
        if tag in VOID or tag in ("html", "body"):
            if tag == "br":
                self.at.children.append(Node("br", {}, self.at))
            return
        places = self.open.get(tag)
        if not places:
            return
        if tag not in ENDS_P and self.containers[-1] > places[-1]:
            return  # a stray inline end tag doesn't close a container
        self._cut_back(places[-1])


# a block closes an open p unless one of these lies between
SCOPE_OF_P = frozenset("article aside body button center div table td th caption object section main nav header footer form ul ol dl li blockquote".split())


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    return builder.root


def is_furniture(node: Node) -> bool:
    """Page furniture by element, role or style, whatever its text."""
    if node.tag in CUT:
        return not (node.tag == "header" and node.inside)  # the title block of an article
    attrs = node.attrs
    if not attrs or node.tag in ("body", "article", "main"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in FURNITURE_ROLES:
        return True
    return "display:none" in attrs.get("style", "").replace(" ", "").lower()


def names(node: Node) -> list[list[str]]:
    """Words of each class and of the id."""
    attrs = node.attrs
    if "class" not in attrs and "id" not in attrs:
        return []
    tokens = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    return [w for w in (WORD.findall(CAMEL.sub(" ", t).lower()) for t in tokens) if w]


SURE, DOUBTFUL, PLAIN = 2, 1, 0


def name_kind(words: list[str]) -> int:
    """What one name says: furniture for certain, perhaps, or nothing."""
    if words[0] in MODIFIERS:
        return PLAIN
    named = [w for w in words if w in FURNITURE]
    if not named:
        return PLAIN
    certain = [w for w in named if w not in AMBIGUOUS]
    pointing = any(w in POINTERS for w in certain)
    rest = [w for w in words if w not in FURNITURE and w not in PLACES and not (pointing and w in ELSEWHERE)]
    if certain and not rest:
        return SURE
    if certain and all(w in OF_ARTICLE for w in rest):
        return SURE  # "post-comments", "article-share"
    if rest and all(w in OF_ARTICLE for w in rest):
        return PLAIN  # "article-header" is the article's own
    return DOUBTFUL if not rest or words[-1] in FURNITURE else PLAIN


def named_furniture(node: Node) -> bool:
    """Furniture by class or id, of any length. Doubtful names cut what is mostly links, or holds
    no prose; what else they name is marked, to be no sibling of the article."""
    if node.tag in NEVER_BY_NAME:
        return False
    kind = max((name_kind(w) for w in names(node)), default=PLAIN)
    if kind == SURE:
        return not node.mains
    if kind == DOUBTFUL:
        if link_density(node) >= 0.5 or not node.prose:
            return True
        node.doubtful = True
    return False


def is_comment(node: Node) -> bool:
    """An article that is a reader comment: by its name, or nested in an article of which
    it isn't the larger part."""
    if node.tag != "article":
        return False
    if any(w[0] in COMMENT_PARTS and any(x in COMMENT for x in w) and all(x in COMMENT_PARTS for x in w) for w in names(node)):
        return True
    return node.article is not None and 2 * node.chars < node.article.chars


def prune(root: Node, cut) -> None:
    """Cut the subtrees for which ``cut`` holds."""
    stack = [root]
    while stack:
        node = stack.pop()
        kept = []
        for c in node.children:
            if isinstance(c, Node):
                if cut(c):
                    kept.append(" ")
                    continue
                stack.append(c)
            kept.append(c)
        node.children = kept


def measure(root: Node) -> list[Node]:
    """Fill in characters and linked characters of every node; returns nodes in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    for node in reversed(order):
        chars = linked = links = prose = mains = 0
        for c in node.children:
            if isinstance(c, str):
                chars += len(c.strip())
            else:
                chars += c.chars
                linked += c.linked
                links += c.links
                prose += c.prose + (c.chars > 0 and c.tag in PROSE)
                mains += c.mains + (c.tag == "main")
        if node.tag == "a":
            linked, links = chars, links + 1
        node.chars, node.linked, node.links, node.prose, node.mains = chars, linked, links, prose, mains
    return order


def link_density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def is_menu(node: Node) -> bool:
    """A list or box that is hardly anything but several links with short labels, whatever its class."""
    return node.tag in MENU_LIKE and node.links >= 3 and link_density(node) >= 0.75 \
        and node.linked < MENU_LABEL * node.links


def own_text(node: Node) -> str:
    """Text of a block without the blocks inside it."""
    out, stack = [], list(reversed(node.children))
    while stack:
        c = stack.pop()
        if isinstance(c, str):
            out.append(c)
        elif c.tag not in BLOCK:
            stack.extend(reversed(c.children))
    return "".join(out)


def points(node: Node) -> float:
    """What a paragraph-like block earns by its own text."""
    if not node.chars or node.tag not in PARAGRAPH:
        return 0.0
    text = " ".join(own_text(node).split())
    return (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - link_density(node)) if text else 0.0


def score(order: list[Node]) -> None:
    """Paragraphs give points to their ancestors: all to the nearest container, half to the
    next one up, and so on, carried up in one pass."""
    for node in reversed(order):
        own, given = points(node), node.passed  # what its children have passed by now
        if node.tag in CONTAINER:
            node.score = own + given
            given /= 2
        if node.parent is not None:
            node.parent.passed += own + given


def final_score(node: Node) -> float:
    return node.score * (1 - link_density(node))


def select(order: list[Node]) -> list:
    """The best container and the siblings that belong to it, in page order."""
    best = None
    for node in order:
        if node.tag in CONTAINER and node.score > 0 and (best is None or final_score(node) > final_score(best)):
            best = node
    if best is None:
        return []
    while best.parent is not None and best.tag in ("tr", "tbody", "td", "ul", "ol", "dl", "blockquote", "figure", "table"):
        best = best.parent  # a part of a table or list is never the whole article
    around, up = None, best
    while up is not None:
        if up.tag == "article" or (up.tag == "main" and around is None):
            around = up
        up = up.parent
    # the outermost article around the best container is the article, title block included; else main is
    best = around or best
    if best.parent is None or best.tag == "main":
        return [best]
    if best.tag == "article":  # with the articles beside it
        return [c for c in best.parent.children if c is best or (isinstance(c, Node) and c.tag == "article" and is_text(c))]
    return [c for c in best.parent.children if c is best or (is_text(c) and not (isinstance(c, Node) and c.doubtful))]


def is_text(c) -> bool:
    """Text that is hardly linked."""
    if isinstance(c, str):
        return bool(c.strip())
    return c.chars > 0 and link_density(c) < 0.25


def blocks(nodes: list) -> list[str]:
    """Texts of the blocks in page order; a block ends where another begins or ends.
    Menus inside the kept nodes are left out."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append(text)

    stack: list = list(reversed(nodes))
    while stack:
        c = stack.pop()
        if c is None:
            flush()
        elif isinstance(c, str):
            run.append(c)
        elif c.tag in BLOCK:
            flush()
            if is_menu(c) and not any(c is n for n in nodes):
                continue
            stack.append(None)
            stack.extend(reversed(c.children))
        else:
            if c.tag in ("br", "wbr"):
                run.append(" " if c.tag == "br" else "")
            stack.extend(reversed(c.children))
    flush()
    return out


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by an empty line; empty if there is none."""
    if not html:
        return ""
    text, named = _article(html, True)
    return text if text or not named else _article(html, False)[0]  # a page that is nothing but furniture by name


def _article(html: str, by_name: bool) -> tuple[str, bool]:
    """The text, and whether something was cut for its name."""
    root, cut = parse(html), []

    def named(node):
        if named_furniture(node) or is_comment(node):
            cut.append(node)
            return True
        return False

    prune(root, is_furniture)
    if by_name:
        measure(root)
        prune(root, named)
    order = measure(root)
    score(order)
    return "\n\n".join(blocks(select(order))), bool(cut)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 500):
            part = b.slice(lo, 500)
            texts = [main_text(h) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points of text).

    Null and empty html give the empty text, as does a page without any text
    outside its furniture. Null ids and urls pass through; repeated rows give
    repeated results; other columns are not read; an empty table gives none.
    """
    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
            .mapInArrow(_extract, "page_id long, url string, text string, n_chars long"))
