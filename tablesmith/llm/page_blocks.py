"""A page as blocks of text under labelled branches: what the style tree counts, and what is extracted from it.

Block elements are branches; inline ones only carry text. Nothing here recurses, so that pages may nest as deep as they
like. Elements come in page order, a parent before its children.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

import xxhash

TOKEN = re.compile(r"""<!--(?:.*?-->|.*)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*+>?|<(/?)([A-Za-z][^\s/>]*)([^>]*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAMED = re.compile(r"\b(?:class|id|role|hidden|style)\b", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# HTML's elements by what they are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: Elements that are no part of an article's text.
ASIDE = frozenset("nav footer aside form button select menu dialog svg canvas object audio video map head input fieldset".split())
#: What the start of an element ends, up to the nearest of the second set.
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "tbody": (frozenset({"tbody", "thead", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
    "thead": (frozenset({"tbody", "thead", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
    "tfoot": (frozenset({"tbody", "thead", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
CELLS, TABLES = frozenset({"td", "th", "caption"}), frozenset("td th caption tr tbody thead tfoot table".split())
#: Roles of accessible pages, and words of names, that mark what stands beside an article.
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner menu menus nav navbar navigation breadcrumb breadcrumbs topbar toolbar"
    " masthead footer sidebar aside widget widgets related recommended recommendations social share sharing newsletter subscribe subscription signup login search cookie cookies consent"
    " gdpr notice notices notification alert popup modal overlay disclaimer copyright comment comments disqus reply replies respond pagination pager skip paywall".split()
)
#: Beginnings of such words that others are put together from: cookiebar, sidebarleft.
NAME_STEMS = ("cookie", "advert", "adsby", "adslot", "adbox", "sidebar", "breadcrumb", "newsletter", "sponsor")
#: Those that count for inline elements, whose names also mark up words of a text (a comment in a listing).
INLINE_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo share sharing skip reply".split())
#: Names of articles that are none: readers' comments, adverts and links to others.
BESIDE = frozenset("comment comments reply sponsored advert ad promo related".split())
#: First words of names that tell of a part elsewhere: has-sidebar, no-comments.
ELSEWHERE = frozenset("has no with without is show hide js".split())
#: Names of a page's main part.
MAIN = frozenset("content main article maincontent main-content page-content post-content entry-content article-content article-body articlebody post-body story-body post entry story".split())

#: Rank of an element as the article's place: a named part, a main or article element.
NAMED_MAIN, REAL_MAIN = 1, 2
_kinds: dict[tuple[str, str], Kind] = {}
_paths: dict[tuple[int, str], int] = {}
CACHED = 200_000


class Block:
    """Text between two borders of blocks, with the links and images in it."""

    __slots__ = ("element", "parts", "features")

    def __init__(self, element: int):
        self.element, self.parts, self.features = element, [], []

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


class Page:
    """parents, keys, labels of elements, whether each stands beside articles, its rank as the article's place; blocks in page order."""

    __slots__ = ("parents", "keys", "labels", "aside", "main", "blocks")

    def __init__(self):
        self.parents, self.keys, self.labels, self.aside, self.main, self.blocks = [-1], [0], ["#document"], [False], [0], []


class Kind(NamedTuple):
    """What an element's tag and attributes say of it; rank: 0, or how surely it is an article's place; loose: it is beside articles only if it holds none."""

    label: str
    aside: bool = False
    rank: int = 0
    header: bool = False
    loose: bool = False


def path_key(parent: int, label: str) -> int:
    """A signed 64-bit number of a branch: its labels from the root on."""
    key = _paths.get((parent, label))
    if key is None:
        if len(_paths) >= CACHED:
            _paths.clear()
        key = _paths[parent, label] = xxhash.xxh64_intdigest(f"{parent}>{label}") - (1 << 63)
    return key


def kind(tag: str, raw: str) -> Kind:
    """Of a tag with these attributes. Digits in names are dropped from the label, so that numbered parts are one branch."""
    found = _kinds.get((tag, raw))
    if found is None:
        if len(_kinds) >= CACHED:
            _kinds.clear()
        found = _kinds[tag, raw] = _kind(tag, raw)
    return found


def _kind(tag: str, raw: str) -> Kind:
    attributes: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(raw):
        attributes.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    names = [*attributes.get("class", "").split(), *attributes.get("id", "").split()]
    words = [[w.lower() for w in PARTS.findall(n)] for n in names]
    told = {w for ws in words if ws and ws[0] not in ELSEWHERE for w in ws}
    role = attributes.get("role", "").lower().strip()
    aside = "hidden" in attributes or bool(HIDDEN.search(attributes.get("style", "")))
    label = ".".join([tag, *sorted(re.sub(r"\d+", "", n) for n in names)])
    if tag in ("html", "body"):
        return Kind(label, aside)
    if tag in ("main", "article") or role in ("main", "article"):
        beside = tag != "main" and role != "main" and told & BESIDE
        return Kind(label, aside or bool(beside), REAL_MAIN)
    rank = NAMED_MAIN if any(n.lower() in MAIN for n in names) else 0
    named = bool(told & INLINE_NAMES) if tag in INLINE else not rank and (bool(told & NAMES) or any(w.startswith(NAME_STEMS) for w in told))
    sure = aside or (tag in ASIDE and tag != "form") or role in ROLES
    return Kind(label, sure or tag == "form" or named, rank, tag == "header" or (not rank and "header" in told), not sure)


def read(html: str) -> Page:
    """The page's branches and blocks. What is left open ends with the page; end tags that fit nothing are dropped."""
    page = Page()
    stack: list[tuple[str, int, bool]] = [("#document", 0, True)]  # tag, the branch it is or stands in, whether it is a branch
    open_tags: Counter = Counter()
    blocks: dict[int, Block] = {}  # the open block of each open branch
    kinds = [Kind("#document")]
    at, pos = 0, 0

    def block() -> Block:
        now = blocks.get(at)
        if now is None:
            now = blocks[at] = Block(at)
            page.blocks.append(now)
        return now

    def add(piece: str) -> None:
        if at in blocks or not piece.isspace():
            block().parts.append(unescape(piece) if "&" in piece else piece)

    def end(depth: int) -> None:
        """Close all that is open from stack[depth] on."""
        nonlocal at
        for tag, element, branch in stack[depth:]:
            open_tags[tag] -= 1
            if branch:
                blocks.pop(element, None)
                if tag not in INLINE:
                    blocks.pop(stack[depth - 1][1], None)
        del stack[depth:]
        at = stack[-1][1]

    while m := TOKEN.search(html, pos):
        if m.start() > pos:
            add(html[pos : m.start()])
        pos = m.end()
        closing, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if tag == "br":
                add(" ")
            elif depth := _opened(stack, tag) if open_tags[tag] > 0 else 0:
                end(depth)
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, pos)
            pos = close.end() if close else len(html)
        elif tag == "br":
            add(" ")
        elif tag == "img":
            block().features.append(raw)
        elif tag in INLINE and not ((named := kind(tag, raw)).aside if NAMED.search(raw) else False):
            if tag == "a":
                block().features.append(raw)
            stack.append((tag, at, False))
            open_tags[tag] += 1
        else:
            if tag not in INLINE:
                named = kind(tag, raw)
                if depth := _ended(stack, tag):
                    end(depth)
                blocks.pop(at, None)
            if tag not in VOID:
                page.parents.append(at)
                page.keys.append(path_key(page.keys[at], named.label))
                page.labels.append(named.label)
                kinds.append(named)
                at = len(kinds) - 1
                stack.append((tag, at, True))
                open_tags[tag] += 1
    if pos < len(html):
        add(html[pos:])
    _settle(page, kinds)
    return page


def _opened(stack: list[tuple[str, int, bool]], tag: str) -> int:
    """The depth of the open element that an end tag ends, 0 if none: an inline one's does not end blocks, and no other than a table's leaves a cell."""
    for depth in range(len(stack) - 1, 0, -1):
        opened = stack[depth][0]
        if opened == tag:
            return depth
        if (tag in INLINE and opened not in INLINE) or (opened in CELLS and tag not in TABLES):
            return 0
    return 0


def _ended(stack: list[tuple[str, int, bool]], tag: str) -> int:
    """The depth of the open element that a start tag ends, 0 if none."""
    last = 0
    closes, within = ENDS.get(tag, (frozenset({"p"}), frozenset()))
    for depth in range(len(stack) - 1, 0, -1):
        opened = stack[depth][0]
        if opened in closes:
            last = depth
        if opened in within or (not within and opened not in INLINE):
            break
    return last


def _settle(page: Page, kinds: list[Kind]) -> None:
    """What stands beside articles, and what in their place: elements take after those round them; a form or a name round an article is only that."""
    holds = [False] * len(kinds)
    for e in range(len(kinds) - 1, 0, -1):
        if holds[e] or kinds[e].rank == REAL_MAIN:
            holds[page.parents[e]] = True
    for e in range(1, len(kinds)):
        p, own = page.parents[e], kinds[e]
        page.aside.append(page.aside[p] or (own.aside and not (own.loose and holds[e])) or (own.header and not page.main[p] and not holds[e]))
        page.main.append(0 if page.aside[e] else max(page.main[p], own.rank))
