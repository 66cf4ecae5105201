"""Exact element lookup on nested HTML (stdlib ``html.parser``).

Regular expressions cannot pair nested tags of the same name, so lookups of
"element X inside block Y" on real portal pages (nested ``div``s) use this
small parser, run as an Arrow-batched ``pandas_udf`` over the rows that need
it (the fetched pages of the refresh work-list).
"""

from __future__ import annotations

from html.parser import HTMLParser

# HTML elements that never have children.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: (v or "") for k, v in attrs})
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.stack[-1].children.append(Node(tag, {k: (v or "") for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse(html: str) -> Node:
    b = _TreeBuilder()
    b.feed(html)
    b.close()
    return b.root


def matches(node: Node, tag: str | None, attr: str | None, value: str | None) -> bool:
    if tag and node.tag != tag:
        return False
    if attr is None:
        return True
    have = node.attrs.get(attr)
    if have is None:
        return False
    if have == value:
        return True
    # a single class name also matches an element carrying several classes
    return attr == "class" and " " not in (value or "") and value in have.split()


def find(node: Node, tag: str | None, attr: str | None, value: str | None) -> Node | None:
    """First descendant (document order) matching the selector."""
    todo = list(reversed([c for c in node.children if isinstance(c, Node)]))
    while todo:
        n = todo.pop()
        if matches(n, tag, attr, value):
            return n
        todo.extend(reversed([c for c in n.children if isinstance(c, Node)]))
    return None


def text(node: Node) -> str:
    """Text of all descendants; ``<br>`` becomes a newline."""
    out: list[str] = []
    todo: list = [node]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out.append(n)
        elif n.tag == "br":
            out.append("\n")
        else:
            todo.extend(reversed(n.children))
    return "".join(out)


def selector_spec(sel) -> tuple[str | None, str | None, str | None] | None:
    """``functions.html.Selector`` -> (tag or None for any, attr, value)."""
    if sel is None:
        return None
    return (sel.tag if sel.tag.isalnum() else None, sel.attr, sel.value)
