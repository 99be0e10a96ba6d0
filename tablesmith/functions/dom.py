"""A small document tree on the standard library's tokeniser: enough of HTML for tables, headings and boxes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Tags that the start of another ends, up to an enclosing element of the second set.
ENDED_BY = {
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"td", "th", "tr"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}), "thead": ({"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}),
    "li": ({"li"}, {"ul", "ol"}), "option": ({"option"}, {"select"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
}
#: Block elements, at whose start a paragraph ends.
ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


class Node:
    """An element with its children, which are elements and texts."""

    def __init__(self, tag: str, attributes: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attributes, self.parent, self.children = tag, attributes or {}, parent, []
        if parent is not None:
            parent.children.append(self)

    @property
    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order."""
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def find(self, test: Callable[[Node], bool]) -> list[Node]:
        return [n for n in self.walk() if test(n)]

    def first(self, test: Callable[[Node], bool]) -> Node | None:
        return next((n for n in self.walk() if test(n)), None)

    def tags(self, *names: str) -> list[Node]:
        return self.find(lambda n: n.tag in names)

    def text(self, skip: Callable[[Node], bool] = lambda n: False) -> str:
        """All text below, without that of elements to skip."""
        return "".join(c if isinstance(c, str) else "" if skip(c) else c.text(skip) for c in self.children)

    def closest(self, test: Callable[[Node], bool]) -> Node | None:
        node: Node | None = self
        while node is not None and not test(node):
            node = node.parent
        return node

    def following(self) -> Iterator[Node]:
        """Later elements of the same parent."""
        after = False
        for n in self.parent.children if self.parent else ():
            if after and isinstance(n, Node):
                yield n
            after = after or n is self

    def next(self) -> Node | None:
        return next(self.following(), None)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#document")

    def _close(self, tags: set[str], within: set[str]) -> None:
        """End the outermost open element of these tags below the nearest enclosing one."""
        node, last = self.at, None
        while node is not self.root and node.tag not in within:
            last = node if node.tag in tags else last
            node = node.parent
        if last is not None:
            self.at = last.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDED_BY:
            self._close(*ENDED_BY[tag])
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, {"div", "td", "th", "table", "li", "section", "article"})
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node is not self.root and node.tag != tag and not (node.tag == "table" and tag != "table"):
            node = node.parent
        if node is not self.root and node.tag == tag:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    """The document's root. Comments and declarations are dropped; what is left open ends with the document."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root
