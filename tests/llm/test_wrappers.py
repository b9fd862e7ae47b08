"""Main texts of pages made from known articles, and tree matching against plain recursion."""

import html as escape
import random
import time

import pytest
from pyspark.sql import functions as F

from tradewind.llm import dom, wrappers
from tradewind.llm.queries import queries

from .conftest import SMALL, prose

TEMPLATES = {
    "article": '<html><head><title>{title}</title><style>p{{}}</style></head><body><header><h1>My site</h1></header><nav><ul><li><a href="/">Home</a></li>'
    "<li><a>{noise}</a></li></ul></nav><!-- ad {noise} --><div class='ad banner'>Buy {noise} now</div><article><h1>{title}</h1>{body}</article>"
    "<aside><p>Also read {noise}</p></aside><section id=comments><h2>Comments</h2><p>{noise} says nice {noise}</p></section><footer>&copy; 2020 {noise}</footer></body></html>",
    "divs": "<!doctype html><body><div id=top class=menu><a>{noise}</a> | <a>About</a></div><div class=wrap><div class=sidebar><p>{noise}</p></div>"
    "<div class=post><h2>{title}</h2>{body}<div class='share-buttons'>Share {noise}</div></div></div><form><p>Sign up {noise}</p><input></form>"
    "<script>var x = '<p>{noise}</p>';</script><div class=cookie-notice>We use cookies</div></body>",
}


def page(kind, k, blocks=None):
    pick = random.Random(k)
    title = f"Title {k} &amp; <i>more</i>"
    blocks = blocks if blocks is not None else [prose(1000 * k + i, pick.randint(15, 60)) + " a < b &c é x" for i in range(pick.randint(3, 9))]
    body = "".join(f"<p>{escape.escape(b)}" + pick.choice(["</p>", "<br>\n", "\n "]) for b in blocks)
    want = [f"Title {k} & more", *(" ".join(b.split()) for b in blocks)]
    return TEMPLATES[kind].format(title=title, body=body, noise=prose(k + 7, 3)), "\n\n".join(want)


@pytest.mark.parametrize("kind", TEMPLATES)
@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_articles_come_back_whole(kind, n):
    pages = [page(kind, k) for k in range(n)]
    assert wrappers.main_texts([p for p, _ in pages]) == [w for _, w in pages]


def test_copies_are_not_template():
    """Equal articles on most pages of a host stay whole."""
    same = [prose(5, 30), prose(6, 40)]
    pages = [page("divs", 1, same) for _ in range(30)] + [page("divs", k) for k in range(2, 5)]
    assert wrappers.main_texts([p for p, _ in pages]) == [w for _, w in pages]


def test_constant_slots_inside_the_content_are_template():
    pages = []
    for k in range(20):
        html, want = page("divs", k)
        pages.append((html.replace("<div class=post>", "<div class=post><p>Printed by the same house since 1900</p>"), want))
    assert wrappers.main_texts([p for p, _ in pages]) == [w for _, w in pages]


def test_query(spark):
    """The articles of the given pages, cut out by hand."""
    import re

    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    out = queries()["op7_wrapper_induction"](spark, SMALL).collect()
    assert len(out) == len(pages)
    for r in out:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        parts = re.split(r"</?(?:p|h1|h2|ul|li|blockquote)\b[^>]*>", inner)
        texts = [" ".join(escape.unescape(re.sub("<[^>]*>", " " if "<br" in p else "", p)).split()) for p in parts]
        assert r.text == "\n\n".join(t for t in texts if t)
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))


def test_odd_pages(spark):
    rows = [
        (1, "http://a.b/x", None), (2, "http://a.b/y", ""), (2, "http://a.b/y", ""), (None, None, "<p>hi"), (3, "no url", "plain < text & more"),
        (4, "http://a.b/z", "<" * 5000), (5, "http://a.b/q", "<div>" * 3000 + "deep" + "</div>" * 3000), (6, "http://A.b/w", "<p>x</b></p></div><script>never closed"),
        (7, "http://a.b/v", "<p>" + "long " * 200_000),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit(1))
    got = {}
    for r in wrappers.extracted(df).collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got[1] == [""] and got[2] == ["", ""] and got[None] == ["hi"] and got[3] == ["plain < text & more"]
    assert got[5] == ["deep"] and got[6] == ["x"] and len(got[7][0]) == 999_999 and len(got[4]) == 1
    assert wrappers.extracted(df.limit(0)).count() == 0


def test_groups_do_not_change_texts(spark):
    pages = [(k, f"https://h{k % 2}.example.org/{k}", page("article", k)[0]) for k in range(60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    want = {k: page("article", k)[1] for k in range(60)}
    for size in (4, 1000):
        assert {r.page_id: r.text for r in wrappers.extracted(df, size).collect()} == want


def weight(a, b):
    """Simple tree matching as it is defined."""
    if a.symbol != b.symbol:
        return 0
    xs, ys = a.children(), b.children()
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, x in enumerate(xs):
        for j, y in enumerate(ys):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight(x, y))
    return 1 + best[-1][-1]


def tree(pick, depth=0):
    node = dom.Node(pick.choice("abc") if depth else "a")
    for _ in range(pick.randint(0, 4) if depth < 3 else 0):
        child = tree(pick, depth + 1)
        child.parent = node
        node.inside.append(child)
    return node


@pytest.mark.parametrize("seed", range(40))
def test_matching_is_largest_and_ordered(seed):
    pick = random.Random(seed)
    a, b = tree(pick), tree(pick)
    dom.shape(a), dom.shape(b)
    pairs = dom.matched(a, b)
    assert len(pairs) == weight(a, b)
    assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)
    partner = {id(x): y for x, y in pairs}
    assert all(x.symbol == y.symbol for x, y in pairs)
    assert all(partner[id(x.parent)] is y.parent for x, y in pairs if x.parent is not None)


OUTSIDE = {
    "title": '<body><div class=menu><a>{noise}</a></div><div class=post><h1>{title}</h1><p>{lead}</p><div class=entry>{body}</div></div><div class=footer>&copy; {noise}</div></body>',
    "sections": "<body><div><a href=/>Home</a> <a href=/b>About</a></div><div class=story><h1>{title}</h1><p>{lead}</p><div class=one>{body}</div><div class=two><p>{last}</p></div></div>"
    "<div>Made by the same <b>old</b> house</div></body>",
}


@pytest.mark.parametrize("kind", OUTSIDE)
@pytest.mark.parametrize("n", [7, 40])
def test_prose_outside_the_main_subtree_stays(kind, n):
    pages, want = [], []
    for k in range(n):
        title, lead, last = f"Title {k}", prose(9000 + k, 12), prose(9500 + k, 40)
        body = [prose(100 * k + i, 40) for i in range(4)]
        parts = dict(title=title, lead=lead, last=last, noise=prose(k, 3), body="".join(f"<p>{b}</p>" for b in body))
        pages.append(OUTSIDE[kind].format(**parts))
        want.append("\n\n".join([title, lead, *body, *([last] if kind == "sections" else [])]))
    assert wrappers.main_texts(pages) == want


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 5000 + "deep words",
        "<a " * 300_000,
        '<a b="' * 150_000,
        "<p>start" + "<!-- x" * 50_000,
        "<script>" * 50_000,
        "</script" * 100_000,
        "x <ul>" + "".join(f"<li class=c{i}>item {i}" for i in range(20_000)),
        "<header>" * 2000 + "x",
    ],
    ids=["deep", "open tags", "open quotes", "open comments", "raw", "open ends", "wide", "headers"],
)
def test_hostile_pages_end_in_seconds(page):
    start = time.time()
    for pages in ([page], [page, page], [page, "<p>hello</p>", page.replace("c1", "d1") + "<p>tail"]):
        assert len(wrappers.main_texts(pages)) == len(pages)
    assert time.time() - start < 30


def test_text_after_the_last_tag_and_open_marks():
    assert wrappers.main_texts(["<p>a</p>b <a c"]) == ["a\n\nb <a c"]
    assert wrappers.main_texts(["<p>a</p>b <!-- c <p>d"]) == ["a\n\nb"]
    assert wrappers.main_texts(["<p>1 < 2 and 2 <3"]) == ["1 < 2 and 2 <3"]


def test_the_header_of_an_article_stays():
    lead = prose(3, 30)
    pages, want = [], []
    for k in range(8):
        body = [prose(50 + 10 * k + i, 40) for i in range(4)]
        pages.append(
            f"<body><header><h1>Our paper</h1></header><div class=story><header><h1>Title {k}</h1><p>{lead} {k}</p></header>"
            + "".join(f"<p>{b}</p>" for b in body) + "</div></body>"
        )
        want.append("\n\n".join([f"Title {k}", f"{lead} {k}", *body]))
    assert wrappers.main_texts(pages) == want


@pytest.mark.parametrize("n", [60, 170])
def test_long_lists_match_as_short_ones_do(n):
    """The partners of a list's head stand behind a new run of children that is longer than any band."""
    pick = random.Random(n)
    inner = "".join
    items = ["<li>" + inner(pick.choice(("<b>x</b>", "<i>x</i>", "<u>x</u>")) for _ in range(6)) + "</li>" for _ in range(n)]
    new = ["<li><s>n</s></li>"] * (n // 2)
    a, b = (dom.parse("<ul><p>h</p>" + inner(x) + "<p>t</p></ul>") for x in (items + new[:3], new + items + ["<li><q>z</q></li>"]))
    dom.shape(a), dom.shape(b)
    assert len(dom.matched(a, b)) == weight(a, b)


def test_lists_of_ten_thousand_children_end_in_seconds():
    pages = ["<ul>" + "".join(f"<li>{'<b>x</b>' * ((k * i) % 40)}</li>" for i in range(10_000)) + "</ul>" for k in (1, 3)]
    start = time.time()
    trees = [dom.parse(p) for p in pages]
    for t in trees:
        dom.shape(t)
    assert len(dom.matched(*trees)) > 10_000 and time.time() - start < 30
