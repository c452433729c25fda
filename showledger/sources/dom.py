"""A small HTML reader for extraction tasks: tags, classes, ids, attributes.

Selectors are sequences of `tag.class#id[attr]`, `[attr=v]`, `[attr^=v]` steps
joined by a space (descendant) or ` > ` (child). Used only inside Spark tasks.
"""

from __future__ import annotations

import re
from html.entities import html5
from html.parser import HTMLParser

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# a start tag of the key closes an open element of the value
_IMPLIED = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"ul", "ol", "table", "div", "article", "section", "body", "html"}
# a page nested deeper than this is no page a browser would lay out; it is rejected
MAX_DEPTH = 2000
_STEP = re.compile(r"([a-zA-Z][\w-]*)|\.([\w-]+)|#([\w-]+)|\[([\w:-]+)(?:(\^?=)[\"']?([^\"'\]]*)[\"']?)?\]")


class TooDeep(ValueError):
    """Nesting beyond MAX_DEPTH."""


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "depth")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        self.depth = parent.depth + 1 if parent is not None else 0

    def walk(self):
        """Descendants in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def drop(self):
        """Take the tree apart: parents and children name each other, so it would wait for the cycle collector."""
        stack = [self]
        while stack:
            node = stack.pop()
            stack.extend(c for c in node.children if isinstance(c, Node))
            node.parent, node.children = None, []

    def text(self) -> str:
        parts: list[str] = []
        stack = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                parts.append(node)
            elif node.tag not in ("script", "style"):
                stack.extend(reversed(node.children))
        return " ".join("".join(parts).split())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        closes = _IMPLIED.get(tag)
        if closes:
            node = self.here
            while node.parent is not None and node.tag not in _SCOPE:
                if node.tag in closes:
                    self.here = node.parent
                    break
                node = node.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.here)
        if node.depth > MAX_DEPTH:
            raise TooDeep(f"nested deeper than {MAX_DEPTH} elements")
        self.here.children.append(node)
        if tag not in _VOID:
            self.here = node

    def handle_endtag(self, tag):
        node = self.here
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.here = node.parent

    def handle_data(self, data):
        self.here.children.append(data)


_NAME = re.compile(r"&(?=#[0-9]+(?![0-9;])|#[xX][0-9a-fA-F]+(?![0-9a-fA-F;])|[a-zA-Z])([a-zA-Z][a-zA-Z0-9]*;?)?")


def _ended_only(html: str) -> str:
    """References without a semicolon written so that they are read as text."""
    return _NAME.sub(lambda m: m[0] if m[1] and m[1][-1] == ";" and m[1] in html5 else "&amp;" + m[0][1:], html)


def parse(html: str, unended: bool = True) -> Node:
    """The tree of a page; with `unended` off, character references need their semicolon (HTML5 lets some go without)."""
    builder = _Builder()
    builder.feed((html or "") if unended else _ended_only(html or ""))
    builder.close()
    return builder.root


def _matches(node: Node, step: list) -> bool:
    for tag, cls, ident, attr, op, value in step:
        if tag and node.tag != tag.lower():
            return False
        if cls and cls not in node.attrs.get("class", "").split():
            return False
        if ident and node.attrs.get("id") != ident:
            return False
        if attr:
            have = node.attrs.get(attr)
            if have is None or (op == "=" and have != value) or (op == "^=" and not have.startswith(value)):
                return False
    return True


def compile_selector(selector: str) -> list[list[tuple[str, list]]]:
    """Comma-separated alternatives of (combinator, step) lists."""
    out = []
    for alternative in selector.split(","):
        steps, combinator = [], " "
        for word in alternative.split():
            if word == ">":
                combinator = ">"
                continue
            steps.append((combinator, _STEP.findall(word)))
            combinator = " "
        out.append(steps)
    return out


def _fits(node: Node, root: Node, steps: list) -> bool:
    if not _matches(node, steps[-1][1]):
        return False
    if len(steps) == 1:
        return steps[-1][0] == " " or node.parent is root
    up = node.parent
    while up is not None and up is not root:
        if _fits(up, root, steps[:-1]):
            return True
        if steps[-1][0] == ">":
            return False
        up = up.parent
    return False


def find(root: Node, compiled):
    """Matching nodes in document order, one after another."""
    return (n for n in root.walk() if any(_fits(n, root, steps) for steps in compiled))


def select(root: Node, compiled) -> list[Node]:
    return list(find(root, compiled))


class Source:
    """`selector|text` or `selector|@attr`, compiled once; an empty selector is the node itself."""

    def __init__(self, source: str):
        selector, _, what = source.rpartition("|")
        self.selector = compile_selector(selector) if selector.strip() else None
        self.attr = what[1:] if what.startswith("@") else None

    def of(self, node: Node) -> str:
        return node.attrs.get(self.attr, "").strip() if self.attr is not None else node.text()

    def first(self, root: Node) -> str:
        """Value of the first match, '' without one; the walk stops there."""
        node = root if self.selector is None else next(find(root, self.selector), None)
        return self.of(node) if node is not None else ""

    def all(self, root: Node) -> list[str]:
        """Non-blank values of all matches."""
        nodes = [root] if self.selector is None else find(root, self.selector)
        return [v for v in map(self.of, nodes) if v]


class Spec:
    """An extraction spec, compiled once for each task."""

    def __init__(self, spec: dict):
        self.item = compile_selector(spec["item"]) if spec.get("item") else None
        self.fields = {name: [Source(s) for s in sources] for name, sources in spec.get("fields", {}).items()}
        self.lists = {name: Source(s) for name, s in spec.get("lists", {}).items()}
        self.unended = spec.get("unended", True)
        self.pairs = [(compile_selector(selector), compile_selector(label)) for selector, label in spec.get("pairs", [])]

    def rows(self, html: str):
        """(fields, lists) of every node the spec selects."""
        root = parse(html, self.unended)
        try:
            yield from self._found(root)
        finally:
            root.drop()

    def _found(self, root: Node):
        for node in find(root, self.item) if self.item else [root]:
            fields = {name: next((v for v in (s.first(node) for s in sources) if v), "") for name, sources in self.fields.items()}
            lists = {name: s.all(node) for name, s in self.lists.items()}
            if self.pairs:
                lists["pairs"] = [p for selector, label in self.pairs for p in read_pairs(node, selector, label)]
            yield fields, lists


def read_pairs(root: Node, selector, label) -> list[str]:
    """`label<TAB>value` of every matching node: its first `label` node, then the rest of its text."""
    out = []
    for node in find(root, selector):
        named = next(find(node, label), None)
        name = named.text() if named is not None else ""
        text = node.text()
        value = text[len(name):].strip(" :") if text.startswith(name) else ""
        if name.strip(" :") and value:
            out.append(name.strip(" :") + "\t" + value)
    return out
