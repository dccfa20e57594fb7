"""Main text of pages."""

from __future__ import annotations

import html
import math
import random
import re
import time

import pytest

from sparkmine.llm import pages

SF_DIR = "/root/testdata/sf0.01"
PARAGRAPH = "A long enough sentence, with commas, that reads like prose. Another one follows it."


def test_given_pages(spark):
    """All pages of the test table: every block of the article, nothing else."""
    table = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    source = {r.page_id: r for r in table.collect()}
    got = pages.extract(table).collect()
    assert len(got) == len(source)
    for r in got:
        article = re.search("<article>(.*)</article>", source[r.page_id].html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("</?b>|<br>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n".join(b for b in blocks if b)
        assert (r.url, r.n_chars) == (source[r.page_id].url, len(r.text))


BOILER = {
    "nav": "<nav><ul><li><a href='/'>Home page, of ours.</a></li></ul></nav>",
    "side bar": f"<aside><p>{PARAGRAPH} side</p></aside><div class='sidebar'><p>{PARAGRAPH} bar</p></div>",
    "cookies": f"<div id='cookie-notice'>{PARAGRAPH} cookies</div>",
    "advert": f"<div class='ad'><p>{PARAGRAPH} buy</p></div>",
    "form": f"<form><label>Name, please.</label><p>{PARAGRAPH}</p><textarea>typed</textarea></form>",
    "comments": f"<section class='comments'><article class='comment'><p>{PARAGRAPH} agreed</p></article></section>",
    "script": "<script>var x = '<p>not text</p>';</script><style>p > b { }</style><!-- <p>comment</p> -->",
    "footer": f"<footer>{PARAGRAPH} &copy;</footer>",
}


@pytest.mark.parametrize("wrap", ["article", "main", "div id='content'", "div class='page with-sidebar'"])
@pytest.mark.parametrize("name", BOILER)
def test_boilerplate_goes(wrap, name):
    body = f"<{wrap}><h2>Title</h2><p>{PARAGRAPH}</p><ul><li>item one</li><li>item <i>two</i></ul><p>{PARAGRAPH}<br>after<p>short</{wrap.split()[0]}>"
    want = f"Title\n{PARAGRAPH}\nitem one\nitem two\n{PARAGRAPH} after\nshort"
    for page in (f"<html><body>{BOILER[name]}{body}</body></html>", f"<html><body>{body}{BOILER[name]}</body></html>"):
        assert pages.main_text(page) == want


SLUGS = ["section id='related-work'", "section id='comments'", "div id='ad-hoc-networks'", "div class='social-history'", "div class='notice-of-findings'", "div class='header-analysis'", "div id='share-of-votes'", "section class='menu-costs'"]


@pytest.mark.parametrize("wrap", ["article", "main", "div class='page no-sidebar'"])
@pytest.mark.parametrize("slug", SLUGS)
def test_slugs_in_the_article_stay(wrap, slug):
    if slug == "section id='comments'" and wrap.startswith("div"):
        return  # the reader comments of a page without an article
    body = f"<h2 id='comments-on-the-method'>Comments on it</h2><p>{PARAGRAPH}</p><{slug}><h3 id='navigation'>Part</h3><p>{PARAGRAPH} here</p></{slug.split()[0]}>"
    page = f"<html><body>{BOILER['nav']}<{wrap}>{body}</{wrap.split()[0]}><div class='ad-slot-2'>{PARAGRAPH}</div><div id='site-footer'>{PARAGRAPH}</div></body></html>"
    assert pages.main_text(page) == f"Comments on it\n{PARAGRAPH}\nPart\n{PARAGRAPH} here"


def test_formulas_and_labels_in_the_article_stay():
    page = f"<body><noscript>Switch it on, please.</noscript><article><p>{PARAGRAPH} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> <object>chart of it</object> <label>a note</label><noscript> shown</noscript></p><p>{PARAGRAPH}</p></article>"
    assert pages.main_text(page) == f"{PARAGRAPH} x=2 chart of it a note shown\n{PARAGRAPH}"


def test_blocks_and_references():
    page = f"<body><article><header><h1>A &amp;lt;b&gt;</h1><p>By someone, today.</p></header><p> {PARAGRAPH}\n\t<b>x</b><i>y</i>&nbsp;z &#233;&eacute;</p><pre>a\n b</pre></article>"
    assert pages.main_text(page) == f"A &lt;b>\n{PARAGRAPH} xy z éé\na b"


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "</p>", "<!--", "<script>", "<a href='x", "<p a='\"'>", "<![CDATA[x]]>", "&", "\x00<b>\x00", "<svg/><path/>"])
def test_broken_pages_do_no_harm(page):
    assert isinstance(pages.main_text(page), str)


def test_long_page_is_whole():
    page = "<article>" + f"<p>{PARAGRAPH}</p>" * 5000 + "</article>" + "<p a='" * 3000
    assert pages.main_text(page).startswith("\n".join([PARAGRAPH] * 5000))


def test_edge_tables(spark, rows):
    df = spark.createDataFrame([(1, None, None, 3), (None, "u", f"<p>{PARAGRAPH}</p>", 3), (2, "u", "", 3), (2, "u", "", 3)], "page_id long, url string, html string, text int")
    assert rows(pages.extract(df)) == sorted([(1, None, "", 0), (None, "u", PARAGRAPH, len(PARAGRAPH)), (2, "u", "", 0), (2, "u", "", 0)], key=repr)
    assert pages.extract(df.limit(0)).collect() == []


UNLISTED = ["recommended", "outbrain", "teaser", "disclaimer", "author-bio", "gdpr-layer"]
OTHER = "Some words of the house, which nobody asked for. They go on, here."


@pytest.mark.parametrize("name", UNLISTED)
def test_ratios_drop_what_no_list_knows(name):
    """No article tag and unknown classes: prose beside the main part and menus inside it."""
    menu = f"<div class='{name}'><ul><li><a href='/1'>First of the links here</a></li><li><a href='/2'>Second one</a></li></ul></div>"
    prose = f"<div class='{name}'><p>{OTHER}</p></div>"
    body = f"<div class='text'><h2>Title</h2><p>{PARAGRAPH}</p>{menu}<p>{PARAGRAPH} <a href='/x'>linked</a>.</p><table><tr><td>7</td><td>cell</td></tr></table><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>"
    want = f"Title\n{PARAGRAPH}\n{PARAGRAPH} linked.\n7\ncell\n{PARAGRAPH}\n{PARAGRAPH}"
    for page in (f"<body>{prose}{menu}{body}</body>", f"<body>{body}{menu}{prose}</body>", f"<body><div>{menu}{body}</div>{prose}</body>"):
        assert pages.main_text(page) == want
        assert pages.main_text(page, lists=False) == want
        assert pages.main_text(page, ratios=False) != want


def test_ratios_overrule_names():
    """The page's only prose is the main text, whatever its element is called."""
    body = f"<h2>Title</h2><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p>"
    want = f"Title\n{PARAGRAPH}\n{PARAGRAPH}"
    assert pages.main_text(f"<body><nav><a href='/'>Home</a></nav><div class='banner-post'>{body}</div></body>") == want
    assert pages.main_text(f"<body><aside>{body}</aside></body>") == want
    assert pages.main_text(f"<body><div class='comments'>{body}</div></body>") == ""
    assert pages.main_text(f"<body><div class='text'>{body}</div><div class='comments'>{body * 20}</div></body>") == want


def test_priors_and_ratios_on_given_pages(spark):
    """Without the lists the ratios still find most pages whole; without both, none."""
    held = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    want = {i: pages.main_text(h) for i, h in held}
    alone = sum(pages.main_text(h, lists=False) == want[i] for i, h in held)
    neither = sum(pages.main_text(h, lists=False, ratios=False) == want[i] for i, h in held)
    assert alone > 0.9 * len(held) and neither < 0.1 * len(held)


def plain_smoothed(parent, ratio):
    """All pairs of paths, by the steps between them: up, down, or to one beside."""
    n, out = len(parent), [0.0] * len(parent)
    for p in range(1, n):
        for q in range(1, n):
            up, up_q = parent[p], parent[q]
            if p == q:
                steps = 0
            elif up == q or up_q == p or up == up_q:
                steps = 1
            elif (up and parent[up] == q) or (up_q and parent[up_q] == p):
                steps = 2
            else:
                continue
            out[p] += ratio[q] * math.exp(-(steps**2) / 2)
    return out


def test_smoothing_against_all_pairs():
    rnd = random.Random(3)
    for _ in range(50):
        parent = [0] + [rnd.randint(0, p - 1) for p in range(1, rnd.randint(2, 40))]
        ratio = [0.0] + [rnd.choice([0.0, rnd.random()]) for _ in parent[1:]]
        assert pages.smoothed(parent, ratio) == pytest.approx(plain_smoothed(parent, ratio))


N = 100_000
LARGE = {
    "deep": "<article>" + "<b>word, " * N,
    "closed": "<div>" * N + PARAGRAPH + "</div>" * N + "</i>" * N,
    "classes": "<article>" + "".join(f"<p class='c{i}'>Some words, here.</p>" for i in range(N)),
    "blocks below inline": "<b>" * N + "<div>a</div>" * N,
    "lists below inline": "<b>" * N + "<li>a" * N,
    "stray ends": "<b>" * N + "</u>" * N,
    "open quotes": "<p a='" * N,
    "marks": "<div class='ad'>" * N + PARAGRAPH,
    "comments": "<!--" * N,
}


@pytest.mark.parametrize("name", LARGE)
def test_large_pages_take_linear_time(name):
    start = time.time()
    text = pages.main_text(LARGE[name])
    assert time.time() - start < 8
    if name in ("deep", "classes"):
        assert text.count(",") == N


@pytest.mark.parametrize("tail", ["<script>var x", "<script>if (a > b) x", "<!-- a > b", "<!-- a", "<style>p {"])
def test_unclosed_ends_are_no_text(tail):
    assert pages.main_text(f"<article><p>{PARAGRAPH}</p>{tail}") == PARAGRAPH
