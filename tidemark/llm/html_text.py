"""Operator 10: main text of a web page by tree scoring.

The page becomes a tree of block elements.  Parts that are never the article
(menus, headers, footers, sidebars, forms, scripts, hidden parts, and parts
whose class, id or role names an advert, a notice, comments and the like) are
left out.  Where a name says this only in part (``social-policy``), or another
one says the opposite (``post comments``), what the part holds decides: it goes
if the rest of the page still reads like an article beside it.  Each block with
text of its own passes points for length and commas to its ancestors, less with
distance and discounted by its share of link text.  The best container is kept,
with siblings that score near it or read like parts of it; lists of links go
where they stand before or after all its text, and stay inside it.  Its blocks
are joined in page order by one newline.

Edge cases: a null or empty page gives an empty text; broken markup is read as
browsers do for the common cases (unclosed paragraphs and list items, stray end
tags, a page cut off inside a tag); repeated rows give repeated results; null
ids and urls stay null; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/][^a-zA-Z>][^>]*(?:>|\Z)|</?>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in (
    "script", "style", "textarea", "title", "noscript", "iframe", "template", "noembed", "noframes", "xmp")}

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby "
                    "s samp small span strike strong sub sup time tt u var".split())
_LEFT_OUT = frozenset("head nav header footer aside form button select menu svg math canvas video audio object "
                      "dialog map datalist fieldset".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_KEEP_ALWAYS = frozenset("html body article main".split())
#: What an opening tag closes, and where the search for it stops.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_JUNK = frozenset("ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs "
                  "comment comments commentlist consent contentinfo cookie cookies disclaimer disqus footer gdpr header "
                  "masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager "
                  "pagination popup popups promo promotion recommended related reply respond search share sharing "
                  "sidebar signup skyscraper social sponsor sponsored subscribe subscription tags toolbar widget "
                  "widgets complementary".split())
_GOOD = frozenset("article content entry main post story".split())
#: Words that say nothing about what a part holds.
_PLAIN = frozenset("area bar block body bottom box center column container first global group holder inner item items "
                   "js last layout left link links list page panel primary reader right section secondary site top "
                   "user wrap wrapper".split())
#: A name that begins so says what a part is not, or only how it is laid out.
_DENIES = frozenset("has hide is no non not with without".split())
_PARTS = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: What a name, or a part, says: article or nothing; doubtful; left out.
_KEPT, _DOUBT, _OUT = 0, 1, 2


class Node:
    """A block element: its text pieces ``(text, in a link)`` and blocks, in order."""

    __slots__ = ("tag", "parent", "items", "good", "doubt", "score", "length", "linked")

    def __init__(self, tag: str, parent: Node | None, good: bool = False, doubt: bool = False):
        self.tag, self.parent, self.good, self.doubt = tag, parent, good, doubt
        self.items: list = []
        self.score = 0.0
        self.length = self.linked = 0


def _name(token: str) -> tuple[int, bool]:
    """What one class name, id or role says; whether it names a main part."""
    parts = [p for p in _PARTS.split(_CAMEL.sub("-", token).lower()) if p]
    junk, good = _JUNK.intersection(parts), not _GOOD.isdisjoint(parts)
    if not junk or parts[0] in _DENIES:
        return _KEPT, good and not junk
    return (_DOUBT, False) if good or not junk | _PLAIN >= set(parts) else (_OUT, False)


def _described(attributes: str) -> tuple[int, bool]:
    """What the attributes say of their element; whether they name a main part."""
    says, good = _KEPT, False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") \
                or (name == "style" and "display:none" in value.replace(" ", "").lower()):
            return _OUT, False
        if name in ("class", "id", "role"):
            for token in value.split():
                one, main = _name(token)
                says, good = max(says, one), good or main
    return (_DOUBT if says == _OUT and good else says), good


def tree(page: str) -> Node:
    """Block tree of a page, without the parts that are left out."""
    root = node = Node("html", None)
    # Open elements: (tag, the node to return to, or None for inline ones).
    stack: list[tuple[str, Node | None]] = []
    opened: Counter[str] = Counter()
    skip: int | None = None  # depth of the element that is being left out
    link: int | None = None  # depth of the open link
    at, size = 0, len(page)

    def close(depth: int) -> None:
        nonlocal node, skip, link
        while len(stack) > depth:
            shut_tag, back = stack.pop()
            opened[shut_tag] -= 1
            if skip is not None and len(stack) <= skip:
                skip = None
            if link is not None and len(stack) <= link:
                link = None
            if back is not None:
                node = back

    def text(piece: str) -> None:
        if piece and skip is None:
            node.items.append((unescape(piece) if "&" in piece else piece, link is not None))

    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if page.startswith("<![CDATA[", m.start()):
                text(page[m.start() + 9:m.end() - 3])
            continue
        tag, rest = name.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            inline = tag in _INLINE
            for depth in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if inline and stack[depth][1] is not None:
                    break  # an inline end tag does not close a block
            if tag == "a" and link is not None:
                link = None
            continue
        if tag in _VOID:
            if tag in ("br", "hr"):
                text(" ")
            continue
        if tag in _END:
            m = _END[tag].search(page, at)
            if m is None:
                break
            at = page.find(">", m.end()) + 1 or size
            continue
        if tag in _INLINE:
            says, _ = _described(rest) if rest else (_KEPT, False)
            stack.append((tag, None))
            opened[tag] += 1
            if skip is None and says == _OUT:
                skip = len(stack) - 1
            if tag == "a":
                link = len(stack) - 1
            continue
        if tag not in ("html", "body"):
            shut, stop = _CLOSES.get(tag, ({"p"}, {"table", "td", "th", "button", "object"}))
            for depth in range(len(stack) - 1, -1, -1) if any(opened[t] > 0 for t in shut) else ():
                if stack[depth][0] in shut:
                    close(depth)
                    break
                if stack[depth][0] in stop:
                    break
            if tag in _HEADINGS and stack and stack[-1][0] in _HEADINGS:
                close(len(stack) - 1)
        if tag == "body" and opened["head"]:
            close(next(i for i, (t, _) in enumerate(stack) if t == "head"))
        says, good = _described(rest) if rest else (_KEPT, False)
        says = _KEPT if tag in _KEEP_ALWAYS else says
        stack.append((tag, node))
        opened[tag] += 1
        if skip is None and (tag in _LEFT_OUT or says == _OUT):
            skip = len(stack) - 1
        child = Node(tag, node, good or tag in ("article", "main"), says == _DOUBT)
        if skip is None:
            node.items.append(child)
        node = child
        if rest.endswith("/") and tag in ("svg", "math", "path"):
            close(len(stack) - 1)
    return root


def in_order(root: Node) -> list[Node]:
    """All blocks, each before what it holds."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(x for x in reversed(n.items) if isinstance(x, Node))
    return out


def settle(root: Node) -> None:
    """Takes out the doubtful parts beside which the rest of the page still has
    a quarter of their plain text; the others count as parts of the article,
    and what is doubtful inside them is settled in the same way."""
    nodes = in_order(root)
    if not any(n.doubt for n in nodes):
        return
    plain = {id(n): 0 for n in nodes}
    for n in reversed(nodes):
        plain[id(n)] += sum(len(x[0].strip()) for x in n.items if not isinstance(x, Node) and not x[1])
        if n.parent is not None:
            plain[id(n.parent)] += plain[id(n)]
    todo = [root]
    while todo:
        top, doubtful = todo.pop(), []
        inside = [x for x in top.items if isinstance(x, Node)]
        while inside:
            n = inside.pop()
            if n.doubt:
                doubtful.append(n)
            else:
                inside += [x for x in n.items if isinstance(x, Node)]
        rest = plain[id(top)] - sum(plain[id(n)] for n in doubtful)
        for n in doubtful:
            if 4 * rest >= plain[id(n)]:
                n.parent.items = [x for x in n.parent.items if x is not n]
            else:
                n.doubt = False
                todo.append(n)


def score(root: Node) -> list[Node]:
    """Sets lengths, link shares and scores; returns all blocks."""
    nodes = in_order(root)
    for n in nodes:
        own = "".join(x[0] for x in n.items if not isinstance(x, Node))
        length = len(" ".join(own.split()))
        linked = sum(len(x[0].strip()) for x in n.items if not isinstance(x, Node) and x[1])
        n.length, n.linked = length, min(linked, length)
        if not length or n.tag in _HEADINGS:
            continue
        commas = own.count(",") + own.count("，") + own.count("、")
        points = (min(1.0, length / 25) + commas + min(length / 100, 3.0)) * (1 - n.linked / length)
        up, level = (n if n.tag in ("div", "section", "article", "main", "td", "body", "html") else n.parent), 1
        while up is not None:
            up.score += points / (1 if level == 1 else 2 if level == 2 else 3 * level)
            up, level = up.parent, level + 1
    for n in reversed(nodes):  # lengths and links of everything inside
        if n.parent is not None:
            n.parent.length += n.length
            n.parent.linked += n.linked
    for n in nodes:
        if n.score > 0:
            n.score = (n.score * (1.5 if n.good else 1.0)) * (1 - n.linked / max(n.length, 1))
    return nodes


def _link_list(n: Node) -> bool:
    """A list whose text is (nearly) all links; a table has cells of its own."""
    return n.tag in ("ul", "ol", "dl", "div", "section") and n.length > 0 and n.linked > 0.8 * n.length


def blocks(root: Node) -> list[tuple[str, bool]]:
    """Texts of the blocks under ``root`` in page order, and whether each is
    part of a list of links."""
    out: list[tuple[str, bool]] = []
    held: list[str] = []
    links: Node | None = root if _link_list(root) else None  # the outermost such list

    def flush() -> None:
        line = " ".join("".join(held).split())
        held.clear()
        if line:
            out.append((line, links is not None))

    todo: list = [(root, iter(root.items))]
    while todo:
        for x in todo[-1][1]:
            if not isinstance(x, Node):
                held.append(x[0])
            else:
                flush()
                if links is None and _link_list(x):
                    links = x
                todo.append((x, iter(x.items)))
                break
        else:
            flush()
            if todo.pop()[0] is links:
                links = None
    return out


def _text(parts: list[tuple[str, bool]]) -> str:
    """Blocks as one text, without the lists of links at its ends."""
    plain = [i for i, (_, links) in enumerate(parts) if not links]
    return "\n".join(x for x, _ in parts[plain[0]:plain[-1] + 1]) if plain else ""


def _belongs(x: Node, best: Node) -> bool:
    """Whether a sibling of the best container is part of the article."""
    if not x.length or _link_list(x):
        return False
    share = x.linked / x.length
    if share < 0.5 and x.score >= max(10.0, 0.2 * best.score):
        return True
    if share >= 0.25:
        return False
    if x.tag == "p" or (x.tag in ("section", "article") and x.tag == best.tag):
        return True
    return x.tag in ("blockquote", "pre", "figure", "ul", "ol", "table") and x.length > 80


def main_text(page: str | None) -> str:
    """The article's text, or an empty string."""
    if not page:
        return ""
    root = tree(page)
    settle(root)
    nodes = score(root)
    best = max(nodes, key=lambda n: n.score)
    if best.score <= 0:
        best = nodes[0]
    if best.parent is None:
        return _text(blocks(best))
    out: list[tuple[str, bool]] = []
    for x in best.parent.items:
        if x is best or (isinstance(x, Node) and _belongs(x, best)):
            out += blocks(x)
    return _text(out)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
