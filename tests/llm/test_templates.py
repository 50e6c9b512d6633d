"""Extraction: blocks of a page, templates of a host, odd pages."""

from __future__ import annotations

import re
from html import unescape

from adsettle.llm import templates as T

SF = "/root/testdata/sf0.001"


def plain(html: str) -> str:
    """Blocks of the given pages' article, by another road: cut at block tags, strip the others."""
    body = html.split("<article>")[1].split("</article>")[0].replace("<br>", " ")
    parts = [re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*(>|$)", "", x))).strip() for x in re.split(r"</?(?:p|h1)[^>]*>", body)]
    return "\n\n".join(x for x in parts if x)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in T.extract(pages).collect()}
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    assert got == {k: (v, len(v)) for k, v in want.items()}


def text(html: str, n=None, root=frozenset()) -> str:
    return T.main_text(html, n, root)


def test_boilerplate():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
    <header><h1>Site</h1></header><nav><a href=x>Home</a></nav>
    <div class="cookie-notice">We use cookies</div><script>if (a < b) "</p>";</script>
    <main><h1>Title &amp; more</h1><p>One <b>bold</b>,\n  two&nbsp;<a href="?a>b">three</a><p>Four<br>five
    <aside>Side</aside><form><p>Sign up</form><div id="comments"><p>First!</p></div><!-- <p>no</p> -->
    <ul><li>a<li>b</ul><table><tr><td>c<td>d</table></main><footer>&copy; me</footer></body></html>"""
    assert text(page).split("\n\n") == ["Title & more", "One bold, two three", "Four five", "a", "b", "c", "d"]


def test_names_with_a_fixed_meaning():
    """Only whole names mark boilerplate; none outside of an article has a say about it; math stays."""
    body = "<article><div class='entry-header'><h1>Title</h1></div><p>Body</p><div class=social-history><p>More</p></div></article>"
    want = "Title\n\nBody\n\nMore"
    assert text(f'<body><div class="site no-sidebar">{body}</div></body>') == want
    assert text(f"<body><div class=sidebar id=menu>{body}</div></body>") == want
    assert "x" in text("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p></article>")
    links = "<article><p>Read</p><ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul></article>"
    assert text(links) == "Read\n\nOne\n\nTwo"
    for name in ("site-header", "cookie-notice", "share-buttons", "commentThread", "primary sidebar"):
        assert text(f"<body><div class='{name}'>gone</div><p>here</p></body>") == "here"


def test_a_megabyte_of_open_elements():
    import tracemalloc

    tracemalloc.start()
    page = "<div class=a>x" * 70_000
    assert T.main_text(page, 9, [{"once": True, "tokens": [1, 2]}]).count("x") == 70_000
    assert tracemalloc.get_traced_memory()[1] < 200_000_000
    tracemalloc.stop()


def test_broken_markup():
    assert text("<article><p>a < b &lt; c &am <b>d") == "a < b < c &am d"
    assert text("<article><p>x</p><a href=\"/y") == "x"
    assert text("<article><p>x<script>var a = 1;") == "x"
    assert text("<article><p>x<!-- open") == "x"
    assert text("plain text only") == "plain text only"
    assert text("") == "" and text("<p> \n&nbsp;</p>") == ""
    assert text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def page(i: int) -> str:
    return (
        f"<html><body><div class=box><a href=/>Start</a> <a href=/n>News</a></div><div class=claim>Always here</div>"
        f"<div class=text><h2>Story {i}</h2>" + "".join(f"<p>Line {i} {j}</p>" for j in range(i % 3 + 1)) + "</div></body></html>"
    )


def test_template_of_a_host(spark):
    """Without article elements, what stands in every page and link slots are left out."""
    rows = [(i, f"https://Site.example/{i}", page(i), "x") for i in range(8)]
    rows += [(100, "https://other.example/", page(3), "x"), (101, None, page(4), "x"), (102, "no address", None, "x")]
    rows += [(103, "https://site.example/c", page(103), "x")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(3)
    got = sorted((r.page_id, r.text) for r in T.extract(pages).collect())
    assert len(got) == len(rows)
    for i, found in got:
        own = [f"Story {i}", *[f"Line {i} {j}" for j in range(i % 3 + 1)]]
        if i < 8 or i == 103:
            assert found.split("\n\n") == own
    others = dict(got)
    assert others[100].split("\n\n")[:2] == ["Always here", "Story 3"] and others[102] == ""


def plain_walk(tokens, classes):
    """Runs by the definition: a class's tokens k times in one order, each run whole in one gap of every run around it."""
    out = {}
    for i, own in enumerate(classes):
        at = [j for j, t in enumerate(tokens) if t in own]
        runs = [at[j : j + len(own)] for j in range(0, len(at), len(own))]
        orders = {tuple(tokens[j] for j in run) for run in runs}
        if at:
            out[i] = (orders.pop() if len(orders) == 1 and len(at) % len(own) == 0 and all(len(set(tokens[j] for j in r)) == len(own) for r in runs) else None, runs)
    return out


def test_classes_nest():
    outer, inner = [1, 2, 3], [7, 8]
    of, sizes = T.numbered([{"tokens": outer}, {"tokens": inner}])
    found, gaps = T.walk([1, 5, 2, 7, 5, 8, 7, 8, 3], of, sizes)
    assert found == {0: [(1, 2, 3), {(-1, 0)}], 1: [(7, 8), {(0, 2)}]} and gaps[1] == (0, 1) and gaps[4] == (1, 1)
    crossed, _ = T.walk([1, 7, 2, 8, 3], of, sizes)
    assert crossed[0][0] == (1, 2, 3) and crossed[1][0] is None
    assert T.walk([1, 3, 2, 1, 2, 3], of, sizes)[0][0][0] is None
    assert len(T.walk([7, 8, 1, 7, 8, 2, 3], of, sizes)[0][1][1]) == 2
    for tokens in ([1, 2, 3, 1, 2, 3], [3, 1, 2], [1, 2], [1, 1, 2, 3], [7, 8, 8, 7]):
        want = plain_walk(tokens, [outer, inner])
        assert {k: v[0] for k, v in T.walk(tokens, of, sizes)[0].items()} == {k: v[0] for k, v in want.items()}


def test_classes_decide_and_not_single_tokens(spark):
    """A sentence in the text of nearly all pages shares its pages with no other token, so it is no template, though a rule
    for each token would take it for one; a notice with its own element, in as many pages, is. Tokens that stand in another
    order on every page are no class."""
    rows = []
    for i in range(20):
        lead = "<p>A common sentence.</p>" if i % 10 else ""
        notice = "<div class=x1><p class=y1>Please note this.</p></div>" if i % 10 != 3 else ""
        pair = ["<p class=p1>Alpha</p>", "<p class=p2>Beta</p>"]
        rows.append((i, f"https://rule.example/{i}", f"<body><div class=text><p>Own {i}</p>{lead}<p>More {i}</p>{''.join(pair[:: 1 if i % 2 else -1])}</div>{notice}</body>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in T.extract(pages).collect():
        lines = r.text.split("\n\n")
        assert ("A common sentence." in lines) == (r.page_id % 10 != 0)
        assert "Please note this." not in lines and f"Own {r.page_id}" in lines and {"Alpha", "Beta"} <= set(lines)


def test_copies_keep_their_text(spark):
    """Pages that are all copies of one another aren't taken for a template."""
    rows = [(i, f"https://copy.example/{i}", "<body><p>Same text</p></body>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in T.extract(pages).collect()} == {"Same text"}


def test_template_chooses_slots_beside_articles(spark):
    """A teaser article doesn't hide the text outside, and template text inside of it goes."""
    rows = [
        (i, f"https://teaser.example/{i}", page(i).replace("<div class=text>", f"<article><p>Share this</p><p><a href=/t{i}>Read {i}</a></p></article><div class=text>"))
        for i in range(8)
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in T.extract(pages).collect():
        i = r.page_id
        assert r.text.split("\n\n") == [f"Story {i}", *[f"Line {i} {j}" for j in range(i % 3 + 1)]]


def test_odd_pages_leave_the_template(spark):
    """Empty, null and differently built pages of a host take nothing from its template; lists of links nest."""
    links = "<ul>" + "<li><a href=/r>Read on at {0}</a></li>" * 3 + "</ul></div></body>"
    rows = [(i, f"https://odd.example/{i}", page(i).replace("</div></body>", links.format(i))) for i in range(12)]
    rows += [(20, "https://odd.example/e", ""), (21, "https://odd.example/n", None)] * 3
    rows += [(22, "https://odd.example/f", "<p>Error 500</p>"), (23, "https://odd.example/g", page(23).replace("</body>", "<div class=box>x</div></body>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in T.extract(pages).collect()}
    for i in range(12):
        assert got[i].split("\n\n") == [f"Story {i}", *[f"Line {i} {j}" for j in range(i % 3 + 1)]]
    assert got[20] == got[21] == "" and got[22] == "Error 500" and "Always here" not in got[23]


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert T.extract(pages).collect() == []
