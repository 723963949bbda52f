"""Main text of web pages by scoring the element tree.

A page is cut into tags and text by one regular expression; open elements form a tree.  Blocks that
can hardly be content (menus, headers, footers, sidebars, forms, scripts, comments, adverts by their
tag, role, class or id) are left out.  Each paragraph earns points for its length and its commas and
passes them to its ancestors, the nearer the more; an element's points are discounted by the share of
its text that stands in links.  A long section may outscore the article it belongs to, so the whole around the best
container is kept: its article, or the element that holds it and its sections; and with it siblings that score well.

Cases: null or empty html gives an empty text; unclosed and stray tags are closed as browsers do;
a page whose tree has no scored element gives the text of its body without the left-out blocks.
Work is row-local; memory is bounded by one page.
"""

from __future__ import annotations

import html as entities
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

#: Fixed sets of element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math select button canvas".split())
DROPPED = RAW | frozenset("head nav aside footer form menu dialog audio video map".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
PARAGRAPHS = frozenset("p pre td blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption".split())
#: A start tag of the key closes an open element of the values first, if no element of the fence lies between.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
FENCE = frozenset("ul ol dl table article section main body div td th".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
#: Words of class and id names, and of roles, that mark what is not the article.
BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|comment\w*|disqus|respond|reply|replies|sidebar|side|footer|foot|"
    r"menu|nav|navbar|navigation|breadcrumb\w*|cookie\w*|consent|notice|alert|popup|modal|overlay|newsletter|subscribe|"
    r"share|sharing|social|related|recommend\w*|pagination|pager|toolbar|masthead|widget|login|signup)(?=$|[\s_-])",
    re.I,
)
BAD_ROLE = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
GOOD_NAME = re.compile(r"article|content|entry|post|story|main|body|text", re.I)
#: Points that an element starts with.
START = {"article": 25, "main": 20, "section": 3, "div": 2, "td": 1, "blockquote": 1, "body": -5, "html": -25, "ul": -3, "ol": -3}
SIBLING_SHARE = 0.2


class Node:
    __slots__ = ("tag", "parent", "children", "points", "chars", "linked", "dropped", "start", "base")

    def __init__(self, tag: str, parent: Node | None, attributes: str = "") -> None:
        self.tag, self.parent = tag, parent
        self.children: list = []  # nodes, and runs of text
        self.points, self.chars, self.linked = 0.0, 0, 0
        self.base = START.get(tag, 0)
        self.dropped = tag in DROPPED
        if attributes.strip():
            pairs = ((k.lower(), v.strip("\"'")) for k, v in ATTRIBUTE.findall(attributes))
            said = {k: v for k, v in pairs if k in ("class", "id", "role", "hidden", "aria-hidden", "style")}
            name = f"{said.get('class', '')} {said.get('id', '')}"
            container = tag in ("article", "main", "body", "html")
            self.dropped |= "hidden" in said or said.get("aria-hidden") == "true"
            self.dropped |= "display:none" in said.get("style", "").replace(" ", "")
            self.dropped |= said.get("role", "").lower() in BAD_ROLE
            self.dropped |= not container and bool(BAD_NAME.search(name))
            self.base += 10 * bool(GOOD_NAME.search(name)) + 20 * (said.get("role", "").lower() in ("main", "article"))


def tree(page: str) -> Node:
    """The element tree; it is never deeper than the open tags are."""
    root = Node("html", None)
    at, node, end = 0, root, len(page)
    lowered = None

    def close(names: set | frozenset, fence: frozenset) -> None:
        nonlocal node
        x = node
        while x is not root and x.tag not in fence:
            if x.tag in names:
                node = x.parent
                return
            x = x.parent

    for m in TAG.finditer(page):
        if m.start() < at:
            continue  # inside raw text
        if m.start() > at:
            node.children.append(page[at : m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if m.group(1):
            x = node
            while x is not root and x.tag != name:
                x = x.parent
            if x is not root:
                node = x.parent
            continue
        if name == "html":
            continue
        if name in CLOSES_P:
            close({"p"}, FENCE)
        if name in CLOSES:
            close(CLOSES[name], FENCE - CLOSES[name])
        child = Node(name, node, m.group(3) or "")
        node.children.append(child)
        if name in VOID or m.group(3) and m.group(3).endswith("/") and name in INLINE:
            continue
        if name in ("script", "style", "textarea", "title", "noscript", "template", "iframe"):
            lowered = page.lower() if lowered is None or len(lowered) != end else lowered
            shut = lowered.find("</" + name, at) if len(lowered) == end else page.find("</" + name, at)
            at = end if shut < 0 else (page.find(">", shut) + 1 or end)
            continue
        node = child
    if at < end:
        node.children.append(page[at:])
    return root


def _visit(root: Node):
    """Nodes in post-order without recursion, left-out ones excepted."""
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        node, done = stack.pop()
        if done:
            yield node
            continue
        stack.append((node, True))
        stack += [(c, False) for c in reversed(node.children) if isinstance(c, Node) and not c.dropped]


def _in_article(node: Node) -> bool:
    while node.parent is not None:
        node = node.parent
        if node.tag in ("article", "main"):
            return True
    return False


def score(root: Node) -> list[Node]:
    """Fill points; the candidates, best first (ties: the earlier one in post-order)."""
    order: list[Node] = []
    for node in _visit(root):
        order.append(node)
        if node.tag == "header" and not _in_article(node):
            node.dropped = True
            continue
        own = [c for c in node.children if isinstance(c, str)]
        text = "".join(own)
        kids = [c for c in node.children if isinstance(c, Node) and not c.dropped]
        node.chars = len(text.split()) + len(text.strip()) + sum(k.chars for k in kids)
        node.linked = node.chars if node.tag == "a" else sum(k.linked for k in kids)
        if node.tag in PARAGRAPHS and node.chars:
            inner = text + "".join(_pieces(node))
            points = 1 + inner.count(",") + min(len(inner) / 100, 3)
            x, distance = node.parent, 1
            while x is not None and distance <= 5:
                x.points += points / distance
                x, distance = x.parent, distance + 1
    candidates = [n for n in order if n.points > 0 and n.tag not in PARAGRAPHS - {"td", "blockquote"} and n.tag not in INLINE]
    for n in candidates:
        n.points = (n.points + n.base) * (1 - n.linked / max(1, n.chars))
    return sorted(candidates, key=lambda n: -n.points)


def _pieces(node: Node):
    """Runs of text below inline children of a block."""
    stack = [c for c in reversed(node.children) if isinstance(c, Node)]
    while stack:
        x = stack.pop()
        if x.dropped:
            continue
        for c in x.children:
            if isinstance(c, str):
                yield c
        stack += [c for c in reversed(x.children) if isinstance(c, Node)]


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node in page order: decoded, blanks made one, empty ones left out."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.dropped:
            if x.tag not in INLINE:
                flush()
        else:
            block = x.tag not in INLINE
            if block:
                flush()
                stack.append(None)
            stack += list(reversed(x.children))
    flush()
    return out


def _named(node: Node) -> bool:
    return node.base >= START.get(node.tag, 0) + 10


def whole(best: Node) -> Node:
    """The element whose content the best container belongs to.

    That is its article, at once and undivided; else its main element, or the outermost one below the body that is
    named as content; else its parent, unless it is named itself.  In these, blocks beside it that are mostly links go."""
    above = [best]
    while above[-1].parent is not None:
        above.append(above[-1].parent)
    marked = next((x for x in above if x.base >= 20), None)
    if marked is best or marked is not None and marked.tag == "article":
        return marked
    named = [x for x in above if _named(x) and x.tag not in ("body", "html")]
    top = marked or (named[-1] if named else best.parent or best)
    for x in above:
        if x is top:
            return top
        for c in x.parent.children:
            if isinstance(c, Node) and c is not x and c.tag not in INLINE and 2 * c.linked >= c.chars > 0:
                c.dropped = True
    return top


def kept(root: Node) -> list[Node]:
    """The whole around the best container and those of its siblings that score well, in page order."""
    ranked = score(root)
    if not ranked:
        return [root]
    best = whole(ranked[0])
    if best.parent is None:
        return [best]
    scored = {id(n) for n in ranked}
    limit = max(10.0, SIBLING_SHARE * best.points)
    out = []
    for c in best.parent.children:
        if c is best:
            out.append(c)
        elif isinstance(c, Node) and not c.dropped:
            dense = c.linked / max(1, c.chars)
            good = id(c) in scored and c.points >= limit
            paragraph = c.tag == "p" and (c.chars > 80 and dense < 0.25 or 0 < c.chars <= 80 and dense == 0)
            heading = c.tag in ("h1", "h2") and c.linked == 0
            if good or paragraph or heading:
                out.append(c)
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return " ".join(b for n in kept(tree(page)) for b in blocks(n))


def _extracted(pages: pd.Series) -> pd.Series:
    return pages.map(main_text)


def extracted(html: Column) -> Column:
    """Main text of a column of pages."""
    return F.pandas_udf(_extracted, "string")(html)
