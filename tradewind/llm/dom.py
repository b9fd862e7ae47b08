"""A forgiving HTML reader, simple tree matching, and the text of blocks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import isqrt

import numpy as np

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is text up to their end tag.
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
# An open element of the right side ends where one of the left side begins.
_ITEM = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_ITEM |= {"tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPE = frozenset("ul ol dl table select body html article section div".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class Node:
    """An element; ``inside`` holds its texts and elements in order."""

    __slots__ = ("tag", "marks", "inside", "parent", "shape", "size")

    def __init__(self, tag: str, marks: str = "", parent: Node | None = None):
        self.tag, self.marks, self.parent = tag, marks, parent
        self.inside: list[str | Node] = []
        self.shape: int | None = None
        self.size = 1

    @property
    def symbol(self) -> tuple[str, str]:
        return self.tag, self.marks

    def children(self) -> list[Node]:
        return [x for x in self.inside if isinstance(x, Node)]

    def own_text(self) -> str:
        return " ".join(" ".join(x for x in self.inside if isinstance(x, str)).split())

    def walk(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(reversed(node.children()))


def parse(html: str) -> Node:
    """The tree of a page. Any text gives a tree; missing and stray end tags are mended."""
    root = Node("#root")
    at, here = 0, root
    last = html.rfind(">") + 1
    while True:
        m = _TOKEN.search(html, at) if at < last else None
        if m is None:  # no tag ends any more; an open comment hides what follows it
            hidden = html.find("<!--", at)
            here.inside.append(unescape(html[at:] if hidden < 0 else html[at:hidden]))
            return root
        if m.start() > at:
            here.inside.append(unescape(html[at : m.start()]))
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        tag = name.lower()
        if m[1] or m[4]:
            node = here
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                here = node.parent
            continue
        rest = m[3] if m[2] else m[6]
        if tag in _ITEM:
            node = here
            while node.parent is not None and node.tag not in _SCOPE and node.tag not in _ITEM[tag]:
                node = node.parent
            if node.tag in _ITEM[tag]:
                here = node.parent
        elif tag not in INLINE and tag not in VOID and tag not in RAW:
            node = here  # a block ends an open paragraph and what is open in it
            while node.parent is not None and (node.tag in INLINE or node.tag == "p"):
                if node.tag == "p":
                    here = node.parent
                    break
                node = node.parent
        marks = " ".join(sorted(f"{a[1].lower()}={a[2] or a[3] or a[4] or ''}".lower() for a in _ATTRIBUTE.finditer(rest or "")))
        node = Node(tag, marks, here)
        here.inside.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at, max(at, last))
            at = end.end() if end else len(html)
        elif tag not in VOID and not (rest or "").rstrip().endswith("/"):
            here = node


def shape(node: Node) -> int:
    """A number for the tags and marks of a tree; nodes also learn the size of their trees."""
    order = list(node.walk())
    for x in reversed(order):
        x.shape = hash((x.tag, x.marks, *[c.shape for c in x.children()]))
        x.size = 1 + sum(c.size for c in x.children())
    return node.shape


def _ends(xs: list[Node], ys: list[Node]) -> tuple[int, int]:
    """How many children agree at the head, and at the tail of the rest."""
    head = 0
    while head < min(len(xs), len(ys)) and xs[head].shape == ys[head].shape:
        head += 1
    tail = 0
    while tail < min(len(xs), len(ys)) - head and xs[-1 - tail].shape == ys[-1 - tail].shape:
        tail += 1
    return head, tail


def _candidates(xs: list[Node], ys: list[Node]) -> Iterator[tuple[Node, Node]]:
    """The pairs of children whose weights a match of two lists may ask for, one for each pair of shapes."""
    head, tail = _ends(xs, ys)
    yield from zip(xs[:head], ys[:head], strict=True)
    yield from zip(xs[len(xs) - tail :], ys[len(ys) - tail :], strict=True)
    left, right = ({n.shape: n for n in ns[head : len(ns) - tail]} for ns in (xs, ys))
    alike: dict[tuple[str, str], list[Node]] = {}
    for y in right.values():
        alike.setdefault(y.symbol, []).append(y)
    for x in left.values():
        yield from ((x, y) for y in alike.get(x.symbol, ()))


def _weigh(a: Node, b: Node, known: dict) -> None:
    """Note for two trees, and for all below them that may be matched, how many nodes can be."""
    todo = [(a, b, False)]
    while todo:
        x, y, ready = todo.pop()
        key = x.shape, y.shape
        if key in known:
            continue
        if x.shape == y.shape:
            known[key] = x.size
        elif ready:
            known[key] = 1 + sum(w for _, _, w in _aligned(x.children(), y.children(), known))
        else:
            todo.append((x, y, True))
            todo += [(p, q, False) for p, q in _candidates(x.children(), y.children()) if (p.shape, q.shape) not in known]


def _aligned(xs: list[Node], ys: list[Node], known: dict) -> list[tuple[Node, Node, int]]:
    """Children matched in order, as many nodes as possible; equal ends match at once."""
    head, tail = _ends(xs, ys)
    out = [(x, y, x.size) for x, y in zip(xs[:head], ys[:head], strict=True)]
    left, right = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
    # A child without one of its symbol on the other side has no partner.
    both = {x.symbol for x in left} & {y.symbol for y in right}
    left, right = ([n for n in ns if n.symbol in both] for ns in (left, right))
    out += _largest(left, right, known) if left else []
    return out + [(x, y, x.size) for x, y in zip(xs[len(xs) - tail :], ys[len(ys) - tail :], strict=True)]


def _largest(left: list[Node], right: list[Node], known: dict) -> list[tuple[Node, Node, int]]:
    """A largest match in order of all of ``left`` with all of ``right``.

    best[j] after i rows: nodes matched by the first i on the left with the first j on the right. Only
    every step-th row is stored; the way back makes the rows between two stored ones again. So memory
    grows with the right side times the root of the left one, and no pair is left out.
    """
    # For each symbol its different shapes on the right, its places there, and which shape stands at each.
    shapes: dict[tuple[str, str], dict[int, int]] = {}
    for y in right:
        own = shapes.setdefault(y.symbol, {})
        own.setdefault(y.shape, len(own))
    places = {symbol: ([], []) for symbol in shapes}
    for j, y in enumerate(right):
        js, which = places[y.symbol]
        js.append(j)
        which.append(shapes[y.symbol][y.shape])
    at = {symbol: (np.array(js), np.array(which)) for symbol, (js, which) in places.items()}
    weights: dict[int, np.ndarray] = {}

    def after(row: np.ndarray, x: Node) -> np.ndarray:
        if x.shape not in weights:
            weights[x.shape] = np.array([known[x.shape, s] for s in shapes[x.symbol]], dtype=np.int32)
        js, which = at[x.symbol]
        new = row.copy()
        new[js + 1] = np.maximum(row[js + 1], row[js] + weights[x.shape][which])
        return np.maximum.accumulate(new, out=new)

    step = isqrt(len(left)) + 1
    row = np.zeros(len(right) + 1, dtype=np.int32)
    stored = []
    for i, x in enumerate(left):
        if i % step == 0:
            stored.append(row)
        row = after(row, x)
    j, found = len(right), []
    for k in range(len(stored) - 1, -1, -1):
        rows = [stored[k]]
        for x in left[k * step : (k + 1) * step]:
            rows.append(after(rows[-1], x))
        for i in range(len(rows) - 1, 0, -1):
            x = left[k * step + i - 1]
            while j:
                y = right[j - 1]
                w = known[x.shape, y.shape] if x.symbol == y.symbol else 0
                if w and rows[i][j] == rows[i - 1][j - 1] + w:
                    found.append((x, y, w))
                    j -= 1
                    break
                if rows[i][j] == rows[i - 1][j]:
                    break
                j -= 1
    return found[::-1]


def matched(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching: the pairs of a largest match of two trees whose shapes are set."""
    out, todo, known = [], [(a, b)] if a.symbol == b.symbol else [], {}
    if todo:
        _weigh(a, b, known)
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        if x.shape == y.shape:
            todo += zip(x.children(), y.children(), strict=True)
        else:
            todo += [(p, q) for p, q, _ in _aligned(x.children(), y.children(), known)]
    return out


def blocks(node: Node, skip) -> list[str]:
    """The texts of the blocks of a tree in page order, white space run together; nodes for
    which ``skip`` holds are left out."""
    out: list[str] = []
    pieces: list[str] = []

    def close() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            out.append(text)

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            pieces.append(x)
        elif x.tag == "br":
            pieces.append(" ")
        elif x.tag not in RAW and not skip(x):
            if x.tag not in INLINE:
                close()
                todo.append(None)
            todo.extend(reversed(x.inside))
    close()
    return out
