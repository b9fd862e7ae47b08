"""Main text of web pages by wrapper induction.

Pages of a host come from a template. In each group of its pages, the trees are aligned with
the tree of one of them by simple tree matching. A place whose text is the same on nearly all
pages is template; places whose text varies are slots, and nodes without a partner belong to
the slot they stand in. The lowest subtree that holds all of the varying prose (or the <article>
or <main> that holds most of it) is the content of the host's pages; a page's text is what its own tree has at that place, without what marks itself
as a menu, advert, notice and the like.

A host with many pages is dealt out over many groups of about GROUP_PAGES pages, by a hash of
the page, so that no task gets a whole large host.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.dom import INLINE, RAW, Node, blocks, matched, parse, shape
from tradewind.session import keep

GROUP_PAGES = 64
# Texts of a place count as template if they agree on this share of at least so many pages.
CONSTANT = 0.9
LEAST_PAGES = 5
# Where more of the content agrees than this, the pages are copies and nothing of it is template.
COPIES = 0.2
# A subtree with over this share of its parent's prose is the main one of the parent.
MOST = 0.7

# Elements and names that are never part of an article.
BOILERPLATE_TAGS = frozenset("nav footer aside form button select input dialog menu object embed audio video canvas head".split())
BOILERPLATE_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert".split())
BOILERPLATE_NAMES = frozenset(
    "nav navbar navigation menu submenu header masthead footer sidebar side aside ad ads adv advert adverts advertisement "
    "banner promo promotion sponsor sponsored cookie cookies consent notice notices alert comment comments disqus reply replies share sharing "
    "social related recommended subscribe newsletter signup login breadcrumb breadcrumbs popup modal overlay widget toolbar pagination pager "
    "skip copyright legal".split()
)
MAIN_TAGS = frozenset(("article", "main"))
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption ul ol dl table tr tbody".split())


def is_boilerplate(node: Node) -> bool:
    """Whether an element says of itself that it is no part of an article."""
    if node.tag in BOILERPLATE_TAGS:
        return True
    if node.tag in ("html", "body", *MAIN_TAGS):
        return False
    if node.tag == "header":  # that of a page, unless it stands in a part of it and has a title
        of_page = node.parent is None or node.parent.tag in ("#root", "html", "body")
        return of_page or not any(x.tag in ("h1", "h2") for x in node.walk())
    for mark in re.findall(r"(class|id|role)=([^=]*?)(?= (?:class|id|role)=|$)", node.marks):
        words = re.split(r"[^a-z]+", mark[1])
        if mark[0] == "role" and BOILERPLATE_ROLES.intersection(words):
            return True
        if mark[0] != "role" and BOILERPLATE_NAMES.intersection(words):
            return True
    return False


def _prose(root: Node, weight) -> dict[int, float]:
    """For each node below ``root`` the prose in its subtree; links and boilerplate have none."""
    total: dict[int, float] = {}

    def visit(top: Node) -> None:
        order, todo = [], [(top, False)]
        while todo:
            node, out = todo.pop()
            out = out or node.tag == "a" or node.tag in RAW or is_boilerplate(node)
            order.append(node)
            total[id(node)] = 0.0 if out else weight(node)
            todo += [(c, out) for c in node.children()]
        for node in reversed(order):
            if node is not top:
                total[id(node.parent)] += total[id(node)]

    visit(root)
    return total


def content_node(root: Node, weight, whole: bool = True) -> Node:
    """The smallest subtree that holds all of the prose, or most of it if not ``whole`` or if
    an <article> or <main> is in there; ``weight`` gives a node's own prose."""
    total = _prose(root, weight)
    marked = {id(x) for x in root.walk() if x.tag in MAIN_TAGS}
    marked |= {id(a) for x in root.walk() if x.tag in MAIN_TAGS for a in _ancestors_all(x)}
    node = root
    while node.tag not in MAIN_TAGS:
        inner = [c for c in node.children() if c.tag not in TEXT_BLOCKS]
        best = max(inner, key=lambda c: total[id(c)], default=None)
        if best is None or total[id(best)] <= MOST * total[id(node)]:
            break
        if whole and id(best) not in marked and total[id(best)] < total[id(node)]:
            break
        node = best
    return node


def _ancestors_all(node: Node):
    while node.parent is not None:
        node = node.parent
        yield node


def _own_length(node: Node) -> float:
    return len(node.own_text())


class Wrapper:
    """What the pages of a group have in common, held against the tree of the first of them."""

    def __init__(self, trees: list[Node]):
        self.first = trees[0]
        for t in trees:
            shape(t)
        self.pairs = [matched(self.first, t) for t in trees]
        self.texts: dict[int, Counter] = {}
        varying: Counter = Counter()
        self.template: set[int] = set()
        for pairs in self.pairs:
            for x, y in pairs:
                self.texts.setdefault(id(x), Counter())[y.own_text()] += 1
        for key, texts in self.texts.items():
            n, most = texts.total(), texts.most_common(1)[0][1]
            if n >= LEAST_PAGES and most >= CONSTANT * n:
                self.template.add(key)
            else:
                varying[key] = sum(len(t) * k for t, k in texts.items())
        for pairs, tree in zip(self.pairs, trees, strict=True):
            # What has no partner varies too; it counts where its nearest partnered node is.
            partner = {id(y): x for x, y in pairs}
            todo = [(tree, self.first, False)]
            while todo:
                node, place, out = todo.pop()
                place = partner.get(id(node), place)
                out = out or node.tag == "a" or node.tag in RAW or is_boilerplate(node)
                if id(node) not in partner and not out:
                    varying[id(place)] += len(node.own_text())
                todo += [(c, place, out) for c in node.children()]
        plain = sum(varying.values()) == 0
        weight = _own_length if plain else lambda x: varying[id(x)]
        self.content, self.main = content_node(self.first, weight), content_node(self.first, weight, whole=False)
        own = {id(x) for x in self.main.walk()}
        fixed = sum(len(self.texts[k].most_common(1)[0][0]) for k in own & self.template)
        size = sum(len(x.own_text()) for x in self.main.walk())
        if fixed > COPIES * size:
            self.template -= {id(x) for x in self.content.walk()}

    def text_of(self, i: int, tree: Node) -> str:
        """The main text of the i-th page; pages without the content's place are judged alone."""
        node = next((y for x, y in self.pairs[i] if x is self.content), None)
        fixed = {id(y) for x, y in self.pairs[i] if id(x) in self.template and y.own_text() == self.texts[id(x)].most_common(1)[0][0]}
        main = next((y for x, y in self.pairs[i] if x is self.main), None)
        if node is None or node.parent is None:
            node, main = content_node(tree, _own_length), content_node(tree, _own_length, whole=False)
        # Beside the main subtree, what has no prose of its own (menus of links) and what is
        # wholly template goes.
        beside: set[int] = set()
        if main is not None and main is not node:
            total = _prose(node, lambda x: 0.0 if id(x) in fixed else _own_length(x))
            inside = {id(x) for x in main.walk()} | {id(x) for x in _ancestors_all(main)}
            beside = {id(x) for x in node.walk() if id(x) not in inside and x.tag not in INLINE and total[id(x)] == 0}

        def skip(x: Node) -> bool:
            if x is node or x.tag in INLINE:
                return x is not node and is_boilerplate(x)
            return is_boilerplate(x) or id(x) in beside or (id(x) in fixed and not x.children() and x.own_text() != "")

        return "\n\n".join(blocks(node, skip))


def main_texts(pages: list[str]) -> list[str]:
    """The main texts of pages from one template. An empty page has the empty text."""
    trees = [parse(p) for p in pages]
    full = [i for i, p in enumerate(pages) if p.strip()]
    out = [""] * len(pages)
    if full:
        wrapper = Wrapper([trees[i] for i in full])
        for k, i in enumerate(full):
            out[i] = wrapper.text_of(k, trees[i])
    return out


def extracted(pages: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """page_id, url and text of each page (page_id, url, html).

    A null or empty page has the empty text. Pages without a host in their url are taken
    together. Repeated rows and null ids stay as they are.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    groups = rows.groupBy("host").agg(F.ceil(F.count("*") / group_pages).alias("groups"))
    groups = keep(groups, "hosts")
    rows = rows.join(groups, "host").withColumn("part", F.pmod(F.xxhash64("page_id", "url", "html"), F.col("groups")))
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("page_id", "ascending"), ("url", "ascending")])
        texts = main_texts([h or "" for h in table.column("html").to_pylist()])
        return pa.table([table.column("page_id"), table.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return rows.groupBy("host", "part").applyInArrow(run, f"page_id {kind}, url string, text string")
