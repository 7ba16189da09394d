"""Main text of HTML pages by composite text density.

Every DOM node gets its characters per tag, adjusted by how much of it is link
text. The node whose children's densities have the largest sum holds the main
text; the least density on its path to the body is the threshold that nodes
beside it must reach to belong to it. Elements that only format words inside a
block (b, br, span, ...) count as its characters, not as tags or children: of two
like paragraphs the one with a bold word is no less dense, nor a text of its own.
"""

from __future__ import annotations

import html
import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parampipe.llm.common import ship_with_tasks, whole_text

ship_with_tasks(__name__)

# Element names of the HTML standard.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style title textarea noscript iframe template xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# elements that count as tags: blocks and links
COUNTED = BLOCK | {"a"}
CLOSED_BY_BLOCK = frozenset(["p"])
# an element that ends when the same kind starts, and the elements the search stops at
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements that are never article text, and names by which pages mark such parts.
NOT_TEXT = frozenset(
    "nav header footer aside form script style noscript iframe template svg button select "
    "textarea title head menu dialog object canvas".split()
)
NOT_TEXT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split()
)
NOT_TEXT_NAMES = frozenset(
    "ad ads advert advertisement advertising adsense banner sponsor sponsored promo breadcrumb breadcrumbs "
    "comment comments disqus cookie cookies consent gdpr footer header masthead menu nav navbar navigation "
    "newsletter notice notices popup modal related share sharing sidebar social subscribe widget".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
# one attribute after the other, so that no value is taken for a name
_ATTRIBUTE = re.compile(
    r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>\"'][^\s>]*+)))?"
)
_WORD = re.compile(r"[a-z0-9]+")


# A class that says a part is beside this one, or is not there, names another part.
_NOT_ITSELF = frozenset("no not without with has had is".split())
_ARTICLE, _CODE = 1, 2
_INSIDE = {"article": _ARTICLE, "pre": _CODE, "code": _CODE}


class Node:
    __slots__ = ("tag", "parent", "children", "named", "dropped", "inside", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, named: bool):
        self.tag, self.parent, self.named = tag, parent, named
        self.dropped = named or (parent is not None and parent.dropped)
        self.inside = (parent.inside if parent else 0) | _INSIDE.get(tag, 0)
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _is_dropped(tag: str, attributes: str, inside: int = 0) -> bool:
    """Whether an element, by its tag and attributes, is no text of the article. `inside`
    tells what it lies in: an article has a header of its own, code has its own comments."""
    if tag in NOT_TEXT and not (tag == "header" and inside & _ARTICLE):
        return True
    if not attributes or attributes.isspace():
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value.strip() in NOT_TEXT_ROLES:
            return True
        if name in ("class", "id") and not inside & _CODE and tag not in ("body", "html", "article", "main"):
            if any(_names_a_part(one, inside) for one in value.split()):
                return True
    return False


def _names_a_part(name: str, inside: int) -> bool:
    """One class or id: a name of such a part, or one put together with it."""
    words = _WORD.findall(name)
    found = [w for w in words if w in NOT_TEXT_NAMES]
    if len(words) > 1:
        if words[0] in _NOT_ITSELF or any(w in _NOT_ITSELF for w in words[1:-1]):
            return False
        # related-work is a section, post-header holds a title
        found = [w for w in found if w != "related" and not (w == "header" and inside & _ARTICLE)]
    return bool(found)


def parse(page: str) -> tuple[Node, list[Node]]:
    """The tree of a page, and its nodes in page order. Text lies in `children` as str."""
    root = Node("html", None, False)
    nodes, open_node, at = [root], root, 0

    def close(names: set | frozenset, stops: set | frozenset) -> None:
        nonlocal open_node
        node = open_node
        while node.parent is not None and node.tag not in stops:
            if node.tag in names:
                open_node = node.parent
                return
            node = node.parent

    while (found := _TAG.search(page, at)) is not None:
        if found.start() > at:
            open_node.children.append(page[at : found.start()])
        at = found.end()
        tag = (found.group(2) or found.group(5) or "").lower()
        if not tag:
            continue
        if found.group(1) or found.group(4):
            if tag == "br":
                open_node.children.append(" ")
            elif tag not in ("html", "body"):
                close({tag}, frozenset() if tag in BLOCK else BLOCK)
            continue
        attributes = found.group(3) or found.group(6) or ""
        if tag in ("html", "body"):
            continue
        if tag in BLOCK:
            close(CLOSED_BY_BLOCK, BLOCK - CLOSED_BY_BLOCK)
        if tag in CLOSES:
            names, stops = CLOSES[tag]
            while (before := open_node) and (close(names, stops) or open_node is not before):
                pass
        node = Node(tag, open_node, _is_dropped(tag, attributes, open_node.inside))
        open_node.children.append(node)
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            open_node = node
    if at < len(page):
        open_node.children.append(page[at:])
    return root, nodes


def _keep_wrapping_forms(nodes: list[Node]) -> None:
    """Some servers write a form around every page: one with most of the page's text, and
    an article, main element or first heading in it, is no form of the page."""
    if not any(n.tag == "form" for n in nodes):
        return
    sizes: dict[int, int] = {}
    titled: set[int] = set()
    for node in reversed(nodes):
        parts = [c for c in node.children if isinstance(c, Node)]
        texts = [] if node.tag in NOT_TEXT - {"form", "header"} else node.children
        sizes[id(node)] = sum(len("".join(c.split())) if isinstance(c, str) else sizes[id(c)] for c in texts)
        if node.tag in ("article", "main", "h1") or any(id(c) in titled for c in parts):
            titled.add(id(node))
    for node in nodes[1:]:
        if node.tag == "form" and id(node) in titled and sizes[id(node)] * 2 > sizes[id(nodes[0])]:
            node.named = False
        node.dropped = node.named or node.parent.dropped


def _measure(root: Node, nodes: list[Node]) -> None:
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, str):
                size = len("".join(child.split()))
                node.chars += size
                node.link_chars += size if node.tag == "a" else 0
            elif not child.dropped:
                node.chars += child.chars
                node.tags += child.tags + (child.tag in COUNTED)
                whole = node.tag == "a"
                node.link_chars += child.chars if whole else child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
    body_links = root.link_chars / max(1, root.chars)
    for node in nodes:
        if node.chars and not node.dropped:
            node.density = _density(node, body_links)
    for node in nodes:
        node.sum = sum(c.density for c in node.children if isinstance(c, Node) and not c.dropped and c.tag in COUNTED)


def _density(node: Node, body_links: float) -> float:
    """Characters per tag, times a logarithm that falls with the share of links."""
    chars, tags = node.chars, max(1, node.tags)
    links, link_tags = max(1, node.link_chars), max(1, node.link_tags)
    plain = max(1, chars - node.link_chars)
    base = math.log(chars / plain * node.link_chars + body_links * chars + math.e)
    ratio = max(1.0, (chars / links) * (tags / link_tags))
    return chars / tags * (math.log(ratio) / math.log(base) if base > 1 else math.log(ratio + 1))


def _densest(live: list[Node]) -> Node:
    """The node with the largest density sum; of equal ones the innermost, and without
    any sum the node with the largest density."""
    key = "sum" if any(n.sum for n in live) else "density"
    return max(reversed(live), key=lambda n: getattr(n, key))


def _article_of(best: Node) -> Node | None:
    """The outermost article or main element around the best node that is nearly as good:
    its density sum is over half the best one's, so it is an article in sections. One that
    holds a whole site has a lower sum and decides nothing."""
    node, found = best, None
    while node is not None:
        if node.tag in ("article", "main") and (node is best or node.sum * 2 > best.sum):
            found = node
        node = node.parent
    return found


def _select(root: Node, nodes: list[Node]) -> list[Node | str]:
    """The nodes whose subtrees are the main text, and text directly in a node around
    the best one, in page order."""
    live = [n for n in nodes if not n.dropped and n.chars]
    if not live:
        return []
    best = _densest(live)
    article = _article_of(best)
    if article is not None:
        best = article
    threshold, node = best.density, best
    while node is not None:
        threshold = min(threshold, node.density)
        node = node.parent
    if best is root or article is not None:
        return [best]
    path, node = set(), best
    while node is not None:
        path.add(id(node))
        node = node.parent
    chosen: list[Node | str] = []
    # an explicit stack: a page may nest deeper than Python calls may
    stack: list[Node | str] = [root]
    while stack:
        node = stack.pop()
        # no node of the path is below the threshold, which is the least of theirs
        if isinstance(node, str) or node is best:
            chosen.append(node)
        elif id(node) in path:
            stack.extend(reversed(node.children))
        elif not node.dropped and node.density >= threshold and node.link_chars * 2 < node.chars:
            chosen.append(node)
    return chosen


def _blocks(chosen: list[Node | str]) -> list[str]:
    blocks: list[str] = []
    pieces: list[str] = []

    def end() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            blocks.append(text)
        pieces.clear()

    for top in chosen:
        stack: list[Node | str | None] = [top]
        while stack:
            item = stack.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                pieces.append(item)
            elif item.tag == "br":
                pieces.append(" ")
            elif not item.dropped:
                if item.tag in BLOCK:
                    end()
                    stack.append(None)
                stack.extend(reversed(item.children))
        end()
    return blocks


def main_text(page: str) -> str:
    """Blocks of the main text, two newlines between them; empty if there is none."""
    root, nodes = parse(page)
    _keep_wrapping_forms(nodes)
    _measure(root, nodes)
    return "\n\n".join(_blocks(_select(root, nodes)))


def main_text_column(page: Column) -> Column:
    @F.pandas_udf("string")
    def of(pages: pd.Series) -> pd.Series:
        return pages.map(main_text)

    return of(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of `pages`: page_id, url, text, n_chars (code points).

    Null and empty pages, and pages without text, have an empty text. Repeated
    rows each get a row; other columns are not read.
    """
    rows = pages.select("page_id", "url", main_text_column(whole_text("html")).alias("text"))
    return rows.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
