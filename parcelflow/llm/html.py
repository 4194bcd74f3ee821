"""Operator 2, main text of a page by composite text density.

A tolerant reader makes a tree of the page. Every node has a density: its characters for each
tag, times a logarithm that falls with the share of its characters in links (composite text
density of the published CETD method). The sum of the densities of its children says how much
a node holds running text; the subtree with the highest sum is the core. The lowest density on
the way from the body to the core is the threshold: beside the way down, subtrees that reach
it are part of the text too. Text between the blocks of a node counts as a block. An ``article`` or ``main`` around the core is taken whole.

Menus, headers, footers, side bars, notices, adverts, forms, scripts and comments by readers are
cut out of the tree first, by their element, role or the words of their class and id. A form, or
an element so named, stays if its text shows that it wraps the article.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.arrays import slices

# Elements of the HTML standard.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset(
    "script style head title noscript iframe template nav footer aside button select option "
    "textarea input svg canvas object embed audio video dialog menu map noembed noframes xmp".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert menu menubar alertdialog".split()
)
#: Words of a class or id that name what is not the article.
CHROME = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors "
    "promo promos promotion banner banners nav navbar navigation menu menus breadcrumb breadcrumbs "
    "sidebar sidebars aside rail footer masthead cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login "
    "comment comments comentarios kommentare disqus respond reply replies discussion share sharing "
    "social related recommended recommendations trending popular widget widgets pagination pager "
    "toolbar skip".split()
)
#: Whole names only: as parts, they tell how an element looks.
WHOLE_NAMES = frozenset("hidden is-hidden visually-hidden".split())
#: A name with one of these tells what an element lacks or holds besides the article.
QUALIFIERS = frozenset("no not has with without".split())
#: A named element that holds the core stays if this many times its text does not stand outside.
OUTSIDE = 4
#: A paragraph ends where one of these begins.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: What an element of the same kind ends, and where the search for it stops.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
SCOPES = frozenset("table td th caption button object html body article section div".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[a-zA-Z/][^<]*\Z",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAMES = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")
TITLED = frozenset("article entry post story content".split())


#: Stands for text and inline elements between the blocks of a node; no element, like a line break.
TEXT = "#text"
NO_ELEMENTS = frozenset({TEXT, "br", "wbr"})


class Node:
    __slots__ = ("tag", "parts", "parent", "named", "chars", "tags", "link_chars", "links", "density", "total")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.parts, self.named = tag, parent, [], False

    def children(self) -> list[Node]:
        return [p for p in self.parts if isinstance(p, Node)]


def _is_chrome(tag: str, attrs: str, inside_article: bool) -> bool:
    if tag in NEVER or (tag == "header" and not inside_article):
        return True
    for m in ATTRIBUTE.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "role" and value in ROLES:
            return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _named_chrome(tag: str, attrs: str, inside_article: bool) -> bool:
    """Whether an element's kind or the words of its class and id say that it is not the article;
    its text decides whether that is so."""
    if tag == "form":
        return True
    whole_page = tag in ("html", "body", "article", "main")
    for m in ATTRIBUTE.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "role" and value == "form":
            return True
        if name not in ("class", "id"):
            continue
        each = [(x, set(NAMES.findall(x))) for x in value.split()]
        each = [(x, words) for x, words in each if not words & QUALIFIERS]
        words = set().union(*(w for _, w in each))
        if whole_page:
            if name == "class" and words & {"comment", "comments"}:
                return True
        elif words & CHROME or any(x in WHOLE_NAMES for x, _ in each):
            return True
        elif words & {"header", "topbar"} and not inside_article and not words & TITLED:
            return True
    return False


def tree(page: str) -> Node:
    """The page's elements without those that are never text; unclosed and stray tags are
    mended the way browsers do."""
    root = Node("html", None)
    open_nodes, cut = [root], []
    at, n = 0, len(page)

    def text(raw: str) -> None:
        if raw and not cut:
            open_nodes[-1].parts.append(html.unescape(raw))

    def close(until: int) -> None:
        del open_nodes[until:]
        while cut and cut[-1] >= until:
            cut.pop()

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m["cdata"] is not None:
            text(m["cdata"])
        elif m["end"]:
            tag = m["end"].lower()
            for i in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[i].tag == tag:
                    close(i)
                    break
                if tag in INLINE and open_nodes[i].tag not in INLINE and open_nodes[i].tag in SCOPES:
                    break
        elif m["tag"]:
            tag, attrs = m["tag"].lower(), m["attrs"] or ""
            if tag in ENDS_PARAGRAPH:
                for i in range(len(open_nodes) - 1, 0, -1):
                    if open_nodes[i].tag == "p":
                        close(i)
                        break
                    if open_nodes[i].tag in SCOPES:
                        break
            if tag in SIBLINGS:
                ends, stops = SIBLINGS[tag]
                last = None
                for i in range(len(open_nodes) - 1, 0, -1):
                    if open_nodes[i].tag in stops:
                        break
                    if open_nodes[i].tag in ends:
                        last = i
                if last:
                    close(last)
            if tag in VOID:
                if not cut:
                    open_nodes[-1].parts.append(Node(tag, open_nodes[-1]))
                continue
            if tag in ("html", "body") and any(x.tag == tag for x in open_nodes[1:] or [root]):
                if tag == "html":
                    continue
            node = Node(tag, open_nodes[-1])
            inside = any(x.tag in ("article", "main") for x in open_nodes)
            if not cut and not _is_chrome(tag, attrs, inside):
                node.named = _named_chrome(tag, attrs, inside)
                open_nodes[-1].parts.append(node)
            elif not cut:
                cut.append(len(open_nodes))
            open_nodes.append(node)
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I).search(page, at)
                at = end.end()
                close(len(open_nodes) - 1)
            elif attrs.rstrip().endswith("/") and tag not in INLINE | ENDS_PARAGRAPH:
                close(len(open_nodes) - 1)
    return root


def _wrap_text(root: Node) -> None:
    """Make text and inline elements that stand between the blocks of a node blocks of their own."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(node.children())
    blocks: set[int] = set()
    for node in reversed(order):
        below = node.children()
        if node.tag not in INLINE | VOID or node.tag == "hr" or any(id(c) in blocks for c in below):
            blocks.add(id(node))
        if not any(id(c) in blocks and c.parts for c in below):
            continue
        parts, run = node.parts, None
        node.parts = []
        for part in parts:
            if isinstance(part, Node) and id(part) in blocks:
                run = None
                node.parts.append(part)
                continue
            if run is None:
                run = Node(TEXT, node)
                node.parts.append(run)
            run.parts.append(part)
            if isinstance(part, Node):
                part.parent = run


def _measure(root: Node) -> None:
    """Characters, tags and links of every subtree, without recursion."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(node.children())
    for node in reversed(order):
        node.chars = sum(len(SPACE.sub("", p)) for p in node.parts if not isinstance(p, Node))
        node.tags, node.links, node.link_chars = 0, 0, 0
        for child in node.children():
            node.chars += child.chars
            node.tags += child.tags + (child.tag not in NO_ELEMENTS)
            node.links += child.links + (child.tag == "a")
            node.link_chars += child.chars if child.tag == "a" else child.link_chars
    body_chars, body_links = max(root.chars, 1), root.link_chars
    for node in order:
        chars, links = max(node.chars, 1), max(node.link_chars, 1)
        plain = max(node.chars - node.link_chars, 1)
        base = chars / plain * node.link_chars + body_links / body_chars * chars + math.e
        share = chars / links * max(node.tags, 1) / max(node.links, 1)
        node.density = (
            node.chars / max(node.tags, 1) * math.log(max(share, 1.0) + 1.0) / math.log(math.log(base) + 1.0)
            if node.chars
            else 0.0
        )
    for node in order:
        node.total = sum(c.density for c in node.children())


def _text(node: Node, out: list[str]) -> None:
    """Text in page order; a block or a line break parts words, an inline element does not."""
    stack: list = [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        if item.tag not in INLINE:
            out.append(" ")
            stack.append(" ")
        stack.extend(reversed(item.parts))


def _in_order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(reversed(node.children()))
    return order


def _core(order: list[Node]) -> Node | None:
    """The subtree with the highest sum of densities."""
    blocks = [x for x in order if x.tag not in INLINE and x.chars]
    if not blocks:
        return None
    core = max(blocks, key=lambda x: x.total)
    return core if core.total else max(blocks, key=lambda x: x.density)


def _drop_named(root: Node) -> bool:
    """Cut the elements of a measured tree that are named as chrome, but not one that wraps the
    article: it holds the core, its text is not mostly links, and either it holds an article or
    main while none stands outside, or little running text stands outside."""
    order = _in_order(root)
    if not any(x.named for x in order):
        return False
    # Running text and articles of each node that are in no named element below it.
    free, articles = {}, {}
    for node in reversed(order):
        own = node.chars - node.link_chars
        held = node.tag in ("article", "main")
        for child in node.children():
            if child.tag == "a":
                continue
            if child.named:
                own -= child.chars - child.link_chars
            else:
                own -= child.chars - child.link_chars - free[id(child)]
                held = held or articles[id(child)]
        free[id(node)], articles[id(node)] = own, held
    way, node = [], _core(order)
    while node is not None:
        way.append(node)
        node = node.parent
    outside, found, stay = free[id(root)], articles[id(root)], set()
    for node in reversed(way):
        if not node.named:
            continue
        plain = node.chars - node.link_chars
        held = node.tag not in ("article", "main") and articles[id(node)]
        wraps = (held and not found) or OUTSIDE * outside < plain
        if not wraps or 2 * node.link_chars > node.chars:
            break
        stay.add(id(node))
        outside, found = outside + free[id(node)], found or articles[id(node)]
    for node in order:
        node.parts = [
            p for p in node.parts if not isinstance(p, Node) or not p.named or id(p) in stay
        ]
    return True


def _chosen(root: Node) -> list[Node]:
    """The subtrees that hold the main text, in page order."""
    core = _core(_in_order(root))
    if core is None:
        return []
    way = [core]
    while way[-1].parent is not None:
        way.append(way[-1].parent)
    for kind in ("article", "main"):
        around = [x for x in way if x.tag == kind]
        if around:
            return [around[-1]]
    threshold = min(x.density for x in way)
    on_way, chosen = set(map(id, way)), []

    def down(node: Node) -> None:
        while node is not core:
            below = node.children()
            where = next(i for i, c in enumerate(below) if id(c) in on_way)
            chosen.append([c for c in below[:where] if c.density >= threshold])
            after.append([c for c in below[where + 1 :] if c.density >= threshold])
            node = below[where]

    after: list[list[Node]] = []
    down(root)
    return [*(x for level in chosen for x in level), core, *(x for level in reversed(after) for x in level)]


def main_text(page: str | None) -> str:
    """The article of a page; empty for a null or empty page and for one without text."""
    if not page:
        return ""
    root = tree(page)
    _wrap_text(root)
    _measure(root)
    if _drop_named(root):
        _measure(root)
    out: list[str] = []
    for node in _chosen(root):
        _text(node, out)
        out.append(" ")
    return SPACE.sub(" ", "".join(out)).strip()


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["id", "url", "text", "n_chars"],
        )


def main_texts(
    df: DataFrame, id_column: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """One row per row of ``df``: id, url, ``text``, ``n_chars`` (code points).

    Character references are decoded, white space becomes one space, blocks are joined in page
    order by one space. A null or empty page has an empty text. Pages are read whole, whatever
    their length; null or repeated ids and urls pass through. Other columns are ignored.
    """
    id_type = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("id"), F.col(url).alias("url"), F.col(page).alias("html"))
    texts = rows.mapInArrow(_extract, f"id {id_type}, url string, text string, n_chars long")
    return texts.withColumnsRenamed({"id": id_column, "url": url})
