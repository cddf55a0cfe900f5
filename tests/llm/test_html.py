"""Main text of pages: minimum cuts against all labellings, pages with known articles, odd rows."""

import os
import random
import re
from html import unescape
from itertools import product

import duckdb
import pytest

from millrace.llm.html import blocks, extract_text, main_text, source_side
from millrace.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body class="with-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/a">About</a></ul></nav>
<div class="cookie-notice">We use cookies to make this site a better place for all. Please accept.</div>
<div id="page"><main><article><h1>A &amp; B</h1><p>First&nbsp; paragraph
 of the <a href="x">story</a> goes on.<p>Second one &lt;here&gt;.<ul><li>one point<li>two</ul>
<div class="advert">Buy this fine thing today, it is the best of things you can buy.</div>
<table><tr><td>cell<td>next</table><form><label>Your mail address for our letter</label><input name=q></form><p>Last.</p></article>
<section class="comments"><h2>Comments</h2><article class="comment"><p>I think that this was a very good article, thank you.</p></article></section></main>
<aside><p>Related: a long text about other stories that you may well like to read.</p></aside></div>
<footer>&copy; 2020 the company that made this site. All rights reserved.</footer></body></html>"""


def test_page():
    assert main_text(PAGE) == "A & B\nFirst paragraph of the story goes on.\nSecond one <here>.\none point\ntwo\ncell\nnext\nLast."


def test_page_without_article():
    text = " ".join(["Words of a long paragraph that tell a story."] * 4)
    page = f"<div class=menu><a href=a>One</a> <a href=b>Two</a></div><div class=story><p>{text}</p><p>Short.</p><p>{text}</p></div><div class=footer>Copyright by us, for ever and a day.</div>"
    assert main_text(page) == f"{text}\nShort.\n{text}"


WORDS = " ".join(["Words of a long paragraph that tell a story."] * 4)
STORY = f"<h1>Title</h1><p>{WORDS}</p><p>Short.</p>"
TEXT = f"Title\n{WORDS}\nShort."


@pytest.mark.parametrize(
    "page",
    [
        f'<article class="post tag-legal category-sponsored">{STORY}</article>',
        f'<article class="entry social-post" id="related">{STORY}</article>',
        f'<main class="with-sidebar">{STORY}</main>',
        f'<div class="content has-sidebar withFooter">{STORY}</div>',
        f'<div class="page-no-sidebar format-aside">{STORY}</div>',
        f'<article><div class="entry-header"><h1>Title</h1></div><p>{WORDS}</p><p>Short.</p></article>',
        f'<article><header><h1>Title</h1></header><p>{WORDS}</p><p>Short.</p></article>',
        f'<article><h1 id="legal-notice">Title</h1><p>{WORDS}</p><p>Short.</p></article>',
    ],
)
def test_names_that_do_not_set_apart(page):
    assert main_text(f"<body><nav><a href=a>Home</a></nav>{page}<footer>By us.</footer></body>") == TEXT


def test_much_text_outweighs_a_name():
    long = "".join(f"<p>{WORDS}</p>" for _ in range(8))
    want = "\n".join([WORDS] * 8)
    assert main_text(f'<div class="banner"><a href=a>Buy</a></div><div class="page footer-fixed">{long}</div><div class="legal"><p>{WORDS}</p></div>') == want
    part = '<div class="related"><p><a href=a>Another story</a></p></div>'
    assert main_text(f'<article><section id="search">{long}{part}</section><div class="ad"><p>{WORDS}</p></div></article>') == want
    assert main_text(f'<article>{STORY}<div class="sidebar"><div class="widget"><p>{WORDS}</p></div></div></article>') == TEXT


@pytest.mark.parametrize(
    "page",
    [
        f'<article><svg/>{STORY}</article>',
        f'<article><svg viewBox="0 0 1 1"><path d="M0"/><g><rect/></g></svg><canvas/>{STORY}</article>',
        f'<article class="post comments-open">{STORY}</article>',
        f'<div class="hentry comments-open"><h1>Title</h1><p>{WORDS}</p><p>Short.</p></div>',
        f'<article class="discussion">{STORY}</article>',
        f'<div class="thread discussion-page">{STORY}</div>',
        f'<article>{STORY}<div class="ad">{"<p>" + WORDS + "</p>"}{"<p>" + WORDS + "</p>"}{"<p>" + WORDS + "</p>"}{"<p>" + WORDS + "</p>"}</div></article>',
        f'<article>{STORY}<div id="comments" class="comments-area"><p>{WORDS}</p></div></article>',
        f'<article>{STORY}</article><article class="comment"><p>{WORDS}</p></article>',
        f'<article>{STORY}<button>Share this</button></article>',
    ],
)
def test_pages_whole(page):
    body = f"<nav><a href=a>Home</a></nav>{page}<footer>By us.</footer>"
    assert main_text(f"<body>{body}</body>") == TEXT
    assert main_text(f'<body><form method="post" action="/">{body}</form></body>') == TEXT


def test_lists_and_short_lines():
    refs = "".join(f'<li><a href="/{k}">Source number {k} of all</a></li>' for k in range(8))
    assert main_text(f"<article>{STORY}<h2>Sources</h2><ul>{refs}</ul></article>") == "\n".join([TEXT, "Sources", *[f"Source number {k} of all" for k in range(8)]])
    page = "<h1>Recipe</h1><ul><li>Salt</li><li>Flour</li></ul><p>Water</p>"
    assert main_text(f"<nav><a href=a>Home</a> <a href=b>All</a></nav>{page}<footer>By us.</footer>") == "Recipe\nSalt\nFlour\nWater"
    assert main_text("<article><p>Press <button>OK</button> to go on with the work.</p></article>") == "Press OK to go on with the work."
    assert main_text(f"<article>{STORY}<form><p>{WORDS}</p><input></form></article>") == TEXT


def test_depth_takes_linear_time():
    deep = "<div>a" * 100_000
    assert len(blocks(deep)) == 100_000
    assert blocks("<div>" * 100_000 + "</section>" * 100_000) == []
    assert main_text("<div>" * 100_000 + f"<p>{WORDS}</p>") == WORDS


def test_formula_in_article():
    math = '<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation encoding="application/x-tex">x = 1</annotation></semantics></math>'
    assert main_text(f"<article><p>So {math} holds for all of them.</p></article>") == "So x=1 holds for all of them."


def test_minimum_cut_with_implied_nodes():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(2, 8)
        s = [round(rng.uniform(-3, 3), 2) for _ in range(n)]
        links = [(i, i + 1, round(rng.uniform(0, 2), 2)) for i in range(n - 1)]
        implied = [(i, j, round(rng.uniform(0, 4), 2)) for i in range(n) for j in range(n) if i != j and rng.random() < 0.2]

        def cost(side):
            return sum(max(x, 0) if not c else max(-x, 0) for x, c in zip(s, side)) + sum(w for i, j, w in links if side[i] != side[j]) + sum(w for i, j, w in implied if side[i] and not side[j])

        assert cost(source_side(s, links, implied)) == pytest.approx(min(map(cost, product([False, True], repeat=n))))


def test_minimum_cut_against_all_labellings():
    rng = random.Random(2)
    for _ in range(150):
        n = rng.randint(1, 8)
        s = [round(rng.uniform(-3, 3), 2) for _ in range(n)]
        links = [(i, j, round(rng.uniform(0, 2), 2)) for i in range(n) for j in range(i + 1, n) if j == i + 1 or rng.random() < 0.2]

        def cost(side):
            return sum(max(x, 0) if not c else max(-x, 0) for x, c in zip(s, side)) + sum(w for i, j, w in links if side[i] != side[j])

        assert cost(source_side(s, links)) == pytest.approx(min(map(cost, product([False, True], repeat=n))))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query_returns_the_articles(spark):
    pages = {i: h for i, h in duckdb.sql(f"SELECT page_id, html FROM '{FOLDER}/pages.parquet'").fetchall()}
    got = QUERIES["op4_main_text"](spark, FOLDER).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:h1|p)>", inner)
        want = [" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
        assert r.text == "\n".join(w for w in want if w) and r.n_chars == len(r.text)


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>"), (3, "u", "plain words without any markup that go on for a while."), (3, "u", "<<<>>&&amp;</x><p a='"), (4, "u", "<div>" * 3000 + "deep" + "</div>" * 3000), (5, "u", PAGE), (5, "u", PAGE), (6, "u", "<article>" + "<p>w w w.</p>" * 5000 + "</article>"), (7, "u", "<article><p>a\x00b</article>")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, text int, n_chars string")
    got = extract_text(df).collect()
    assert len(got) == len(rows) and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 6] == ["\n".join(["w w w."] * 5000)]
    assert extract_text(df.limit(0)).count() == 0 and blocks("") == []
