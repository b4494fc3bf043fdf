"""Main text of web pages by tree scoring.

A page is parsed to a light tree (tolerant of unclosed and crossing tags). Parts
that are boilerplate by their element, role or class words are cut out: menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments
of readers. A form, or an element with such a class word, is a wrapper and stays if
it contains the page's article or main element or most of its text outside links
(``settle``); then only its boilerplate parts are cut. A name counts by its whole words;
one with other words beside it ("share-price"), or on a paragraph, is doubtful: such an element
goes only if it is mostly links or, no paragraph itself, has under ``LITTLE`` characters. Every remaining paragraph earns points, one plus one per comma plus one
per hundred characters (three at most); its parent receives them in full, the
grandparent half and higher ancestors less and less. A container's score is its
points times the share of its text that is outside links. The best container wins;
if it lies in an ``article`` or ``main`` element, that element stands for it, and
headings, paragraphs, articles and containers of paragraphs beside it join it if they
are not mostly links. On other pages
all that is left of the page joins the best container, however short and far from
it, except blocks whose text is mostly links.

The text of the chosen parts is written out block by block in page order: character
references are decoded, white space inside a block becomes one space, blocks are
joined by one space, and nothing is cut short.

Defined results: null, empty or textless html gives an empty text; a page without
any paragraph gives what text is left after the cut.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp"}
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
            "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
            "option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend"}
# an opening tag ends an open element of its group, up to the group's border
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
           "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"})}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PARAGRAPH = {"p", "pre", "blockquote", "td", "li", "dd", "figcaption"}
KEPT_WHOLE = {"html", "body", "article", "main"}
CUT = set("head script style noscript template iframe object embed svg canvas nav header footer aside menu form "
          "button select textarea input label fieldset dialog audio video noembed noframes xmp title".split())
# cut by name or as a form, unless they turn out to wrap the text (``settle``); MAYBE: only if links or few words
HARD, MAYBE, NAMED, READERS = 1, 2, 3, 4
LITTLE = 80  # characters
READER_WORDS = set("comment comments commentlist discussion replies disqus respond".split())
SAYS_OF_CONTENT = {"has", "have", "with", "without", "no"}  # "has-sidebar" is no name of a sidebar
CUT_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar "
                "form status".split())
CUT_WORDS = set("ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion banner "
                "cookie cookies consent gdpr notice notices notification popup modal overlay sidebar aside widget menu "
                "menus nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar masthead header footer "
                "comment comments commentlist discussion replies disqus respond share sharing social related "
                "recommended newsletter subscribe subscription signup login search skip".split())
# words that may stand beside a cut word in a name of boilerplate; any other word ("lead-social-policy") makes it doubtful
BESIDE_WORDS = set("box container wrapper wrap inner outer left right top bottom main site page global primary secondary "
                   "section area block list bar slot unit panel link links button buttons icon icons item items text "
                   "content post posts article articles story stories news entry blog user reader view mobile desktop "
                   "sticky fixed small large wide row col column group the and of in for js".split())
# a paragraph with such a name is boilerplate however much it says; with another one it is only if it is links
ADVERT_WORDS = set("ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion "
                   "banner cookie cookies consent gdpr notice notices notification popup modal overlay newsletter "
                   "subscribe subscription signup login comment comments".split())

# In a tag a quote opens a value only after an equals sign; one that is never closed is an ordinary character.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s>/=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
PART = re.compile(r"[^\W_]+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "kind", "points", "chars", "linked", "holds", "free", "free_holds")

    def __init__(self, tag: str, parent: Node | None, cut: bool = False, kind: int = 0):
        self.tag, self.parent, self.cut, self.kind = tag, parent, cut, kind
        self.children: list[Node | str] = []
        self.points, self.chars, self.linked = 0.0, 0, 0


def name_kind(name: str, paragraph: bool) -> int:
    """What one class word or id says: READERS, NAMED, MAYBE or nothing (0)."""
    words: list[str] = []
    for part in PART.findall(name):
        letters = part.rstrip("0123456789")  # "ad2" is a name, "x5ad3" and "12ad" are not
        words += [w.lower() for w in WORD.findall(letters)] if letters.isascii() and letters.isalpha() else [part]
    if not words or words[0] in SAYS_OF_CONTENT or CUT_WORDS.isdisjoint(words):
        return 0
    if not CUT_WORDS.union(BESIDE_WORDS).issuperset(w for w in words if not w.isdigit()):
        return MAYBE
    if paragraph and ADVERT_WORDS.isdisjoint(words):
        return MAYBE
    return NAMED if READER_WORDS.isdisjoint(words) else READERS


def boilerplate(tag: str, attributes: str) -> int:
    """HARD by element, role or being hidden; READERS, NAMED or MAYBE by class words, NAMED as a form; else 0."""
    if tag in CUT and tag != "form":
        return HARD
    kind = NAMED if tag == "form" else 0
    if attributes and len(attributes) > 1:
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "role" and \
                    value.lower() in CUT_ROLES or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                return HARD
            if name in ("class", "id"):
                kind = max([kind, *(name_kind(one, tag in PARAGRAPH or tag in HEADINGS) for one in value.split())])
    return kind


def parse(html: str) -> Node:
    """Light tree of a page."""
    root = Node("#root", None)
    at, pos, n = root, 0, len(html)
    path: list[Node] = []  # open elements
    opened: dict[str, list[int]] = {}  # places in ``path`` of the open elements of a kind

    def close(place: int) -> None:
        nonlocal at
        while len(path) > place:
            opened[path.pop().tag].pop()
        at = path[-1] if path else root

    while pos < n:
        m = TOKEN.search(html, pos)
        if m is None:
            at.children.append(html[pos:])
            break
        if m.start() > pos:
            at.children.append(html[pos:m.start()])
        pos = m.end()
        if m.group(1) is not None:
            at.children.append(m.group(1).replace("&", "&amp;"))
        if m.group(3) is None:
            continue
        tag, attributes = m.group(3).lower(), m.group(4)
        if m.group(2):
            if opened.get(tag):
                close(opened[tag][-1])
            elif tag == "p" or tag == "br":
                at.children.append(Node("br", at))
            continue
        if tag in CLOSES_P and opened.get("p"):
            close(opened["p"][-1])
        if tag in IMPLIED:
            group, border = IMPLIED[tag]
            edge = max((opened[b][-1] for b in border if opened.get(b)), default=-1)
            inside = [places[k] for places in (opened.get(g, ()) for g in group)
                      if (k := bisect_right(places, edge)) < len(places)]
            if inside:
                close(min(inside))
        kind = boilerplate(tag, attributes)
        node = Node(tag, at, at.cut or kind == HARD and tag not in KEPT_WHOLE, kind)
        at.children.append(node)
        if tag in RAW:  # up to its end tag, unparsed
            end = re.compile(rf"</{tag}\s*(?:>|\Z)", re.I).search(html, pos)
            stop, pos = (end.start(), end.end()) if end else (n, n)
            node.children.append(html[m.end():stop])
        elif tag not in VOID and not attributes.endswith("/"):
            opened.setdefault(tag, []).append(len(path))
            path.append(node)
            at = node
    return root


def in_order(root: Node) -> list[Node]:
    """Nodes that are not cut, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.cut]
    return out


def own_text(node: Node) -> str:
    """Text of ``node`` without what is cut, blocks and line breaks apart."""
    out: list[str] = []
    stack: list[Node | str] = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x if x == " " else unescape(x))
        elif not x.cut:
            if x.tag == "br" or x.tag in BLOCK:
                out.append(" ")
                stack.append(" ")
            stack += reversed(x.children)
    return " ".join("".join(out).split())


def measure(node: Node) -> tuple[int, list[Node]]:
    """Length of the node's own text and its elements; sets text and link lengths from those of its elements."""
    text = sum(len(c) if c.isprintable() and " " not in c else len(" ".join(c.split()))
               for c in node.children if isinstance(c, str))
    inner = [c for c in node.children if isinstance(c, Node) and not c.cut]
    node.chars = text + sum(c.chars for c in inner)
    node.linked = node.chars if node.tag == "a" else sum(c.linked for c in inner)
    return text, inner


def settle(root: Node) -> None:
    """Cuts what is boilerplate by name or a form, except wrappers of the text.

    A wrapper contains a ``main``, or an ``article`` that is neither named as boilerplate nor mostly links; or, where
    no such element stands outside it, more than half of the page's text outside links. What is named after comments
    of readers counts as a wrapper only if no such element, or else no text, stands outside it.
    """
    named = lambda x: x.kind > HARD and x.tag not in KEPT_WHOLE
    nodes = in_order(root)
    if not any(map(named, nodes)):
        return
    for x in reversed(nodes):
        text, inner = measure(x)
        own = int(x.tag == "main" or x.tag == "article" and x.kind in (0, MAYBE) and density(x) < 0.5)
        x.holds = own + sum(c.holds for c in inner)
        # the same and the text outside links, without what lies in named elements further down
        x.free_holds = own + sum(c.free_holds for c in inner if not named(c))
        x.free = 0 if x.tag == "a" else text + sum(c.free for c in inner if not named(c))
    whole = root.chars - root.linked
    stack = [(root, root.free, root.free_holds)]  # with the text and holders outside what is named, or in its wrappers
    while stack:
        x, free, holds = stack.pop()
        if named(x):
            others = holds > 0
            if x.kind == MAYBE:
                x.cut = not x.holds and (density(x) >= 0.5 or x.chars < LITTLE and not (
                    x.tag in PARAGRAPH or x.tag in HEADINGS))
            elif x.holds:
                x.cut = x.kind == READERS and others
            else:
                x.cut = others or 2 * (x.chars - x.linked) <= whole or density(x) >= 0.5 or x.kind == READERS and free > 0
            if x.cut:
                continue
            free, holds = free + x.free, holds + x.free_holds
        stack += [(c, free, holds) for c in x.children if isinstance(c, Node) and not c.cut]


def score(nodes: list[Node]) -> None:
    """Points, text and link lengths of all nodes."""
    for node in reversed(nodes):
        text, inner = measure(node)
        blocks = any(c.tag in BLOCK for c in inner)
        if node.chars and (node.tag in PARAGRAPH and not blocks or node.tag in ("div", "section", "p") and text
                           and not (node.tag != "p" and blocks and text < 25)):
            commas = sum(c.count(",") for c in node.children if isinstance(c, str)) + sum(
                s.count(",") for c in inner if c.tag not in BLOCK for s in c.children if isinstance(s, str))
            points = 1.0 + commas + min(node.chars / 100, 3.0)
            up, level = node.parent, 1
            while up is not None and level < 6:
                up.points += points / (1 if level == 1 else 2 if level == 2 else 3 * level)
                up, level = up.parent, level + 1


def density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def runs(node: Node, apart: Node | None = None) -> Iterator[Node]:
    """Block children of ``node`` (and ``apart``), and in their places the runs of text and inline elements between."""
    run: list[Node | str] = []
    for x in [*node.children, None]:
        block = x is None or isinstance(x, Node) and (x is apart or x.tag in BLOCK or any(
            isinstance(c, Node) and c.tag in BLOCK for c in x.children))
        if block and run:
            out = Node("span", node)
            out.children = run
            measure(out)
            yield out
            run = []
        if isinstance(x, str) or x is not None and not x.cut and not block:
            run.append(x)
        elif x is not None and not x.cut:
            yield x


def around(best: Node) -> list[Node]:
    """``best`` and all other text of the page that isn't mostly links, in page order."""
    before: list[list[Node]] = []
    after: list[Node] = []
    node = best
    while node.parent is not None:
        found: list[Node] = []
        stack = list(reversed([*runs(node.parent, node)]))
        while stack:
            x = stack.pop()
            if x is node:
                before.append(found)
                found = []
            elif x.linked < x.chars and density(x) < 0.5:
                found.append(x)
            elif x.linked < x.chars and x.tag != "span":  # the text among the links
                stack += reversed([*runs(x)])
        after += found
        node = node.parent
    return [x for part in reversed(before) for x in part] + [best] + after


def chosen(root: Node) -> list[Node]:
    """Best container with the text around it, in page order."""
    settle(root)
    nodes = in_order(root)
    score(nodes)
    total = lambda x: x.points * (1 - density(x))
    holders = [x for x in nodes if x.points > 0 and x.parent is not None]
    if not holders:
        return [root]
    best = max(holders, key=total)  # the first of equals
    up, outer = best, None
    while up is not None:
        if up.tag in ("article", "main"):
            outer = up
        up = up.parent
    if outer is None:
        return around(best)
    beside = lambda x: x.tag in HEADINGS or x.points > 0 or x.tag in PARAGRAPH and x.chars > 0
    return [x for x in outer.parent.children if isinstance(x, Node) and not x.cut and (
        x is outer or beside(x) and density(x) < 0.5)]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    return " ".join(t for t in map(own_text, chosen(parse(html))) if t)


def extracted(html: str | Column) -> Column:
    """Main text of an html column."""

    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return of(html)
