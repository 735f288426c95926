"""HTML extraction: the fixture's articles and hand-made pages."""

import html
import random
import re
import time
from collections import Counter

import pytest
from spanroute.llm import html_text as H


def plain(page):
    article = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1|br)[^>]*>", " ", article))).split())


def test_fixture_pages(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    want = sorted((r.page_id, r.url, plain(r.html), len(plain(r.html))) for r in pages.collect())
    assert sorted(map(tuple, H.extract_pages(pages).collect())) == want


LONG = "Words of the article go on and on, as articles do, until the line is full of them. "

PAGES = {
    "plain": (f"<p>{LONG}</p>", LONG),
    "empty": ("", ""),
    "only menu": ("<nav><a href=x>Home</a></nav>", ""),
    "divs": (f"<div class=menu>a <a>b</a></div><div id=main><h1>Head</h1><div><p>{LONG}<p>Yes.</div></div><div class='side sidebar'>{LONG}</div>", f"Head {LONG}Yes."),
    "inline": ("<article><p>a<b>b</b>c&amp;&#233;&nosuch; <i>d</i><br>e</p></article>", "abc&é&nosuch; d e"),
    "comments": (f"<article><h1>T</h1><p>{LONG}</p><section class='comments'><p>{LONG}</p></section></article>", f"T {LONG}"),
    "article header": (f"<header><p>Site</p></header><article><header><h1>T</h1></header><p>{LONG}</p></article><aside>{LONG}</aside>", f"T {LONG}"),
    "scripts": (f"<article><script>var a='<p>no</p>'</script><style>p{{}}</style><p>{LONG}<!-- no --></p><form>no<input></form></article>", LONG),
    "cut off": (f"<html><body><article><p>{LONG}<p>and <b>th", f"{LONG}and th"),
    "cookie": (f"<div class='cookie-notice'>{LONG}</div><main><p>{LONG}</p></main>", LONG),
    "teaser": (f"<body><h1>T</h1><p>{LONG * 3}</p><article><p>{LONG}</p></article></body>", f"T {LONG * 3}{LONG}"),
    "teaser in main": (f"<main><p>{LONG * 3}</p><article><p>{LONG}</p></article></main>", LONG * 4),
    "parts": (f"<main><article><p>1 {LONG}</p></article><article><p>2 {LONG * 2}</p></article><article><p>Short.</p></article></main>", f"1 {LONG}2 {LONG * 2}Short."),
    "named wrapper": (f"<div class='page has-sidebar'><div><p>{LONG * 9}</p></div><div class=sidebar>Side {LONG}</div></div>", LONG * 9),
    "form": (f"<body><form id=aspnetForm><nav>Home</nav><p>{LONG}</p></form></body>", LONG),
    "widgets": (f"<p>x</p>" + f"<div class='elementor-widget elementor-widget-text-editor'><p>{LONG}</p></div>" * 3, "x " + LONG * 3),
    "no names": (f"<div><a>Home</a> <a>News</a></div><h1>Title</h1><p>{LONG * 2}</p><p>Yes.</p><p>{LONG}</p><div>Privacy</div>", f"Title {LONG * 2}Yes. {LONG}"),
    "random names": (f"<div class=q1><ul><li><a>Home</a><li><a>News</a></ul></div><div class=q2>Buy it.</div><div class=q3><h1>T</h1><p>{LONG}</p><p>No?</p><p>{LONG}</p></div><div class=q4><a>Terms</a></div>", f"T {LONG}No? {LONG}"),
    "related work": (f"<article><h1>T</h1><p>{LONG}</p><section class='related-work section'><h2>Related work</h2><p>{LONG * 2}</p></section></article>", f"T {LONG}Related work {LONG * 2}"),
    "related links": (f"<article><h1>T</h1><p>{LONG}</p><div class='related'><a>One</a> <a>Two</a></div></article>", f"T {LONG}"),
    "links without a name": (f"<article><h1>T</h1><p>{LONG}</p><div class=q><ul><li><a>One</a><li><a>Two</a></ul></div><p>{LONG}</p></article>", f"T {LONG}{LONG}"),
    "link in a text": (f"<article><p>{LONG}<a>{LONG}</a></p><p><a>All of it</a></p></article>", f"{LONG}{LONG}All of it"),
    "item list": (f"<article><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>3<td>4</table></article>", f"{LONG}one two 3 4"),
}


@pytest.mark.parametrize("name", PAGES)
def test_hand_made(name):
    page, want = PAGES[name]
    assert H.main_text(page) == want.strip()


def test_long_and_fed_in_parts(monkeypatch):
    page = "<article>" + "".join(f"<p>{i} &amp; {LONG}</p>" for i in range(5_000)) + "</article>"
    whole = H.main_text(page)
    monkeypatch.setattr(H, "FEED", 1000)
    assert H.main_text(page) == whole and whole.count("&") == 5_000


def test_nulls_names_and_empty(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (1, "u", "<p>a", "y"), (None, "u", "", "z")], "page_id long, url string, html string, text string")
    got = sorted(map(tuple, H.extract_pages(pages).collect()), key=str)
    assert got == [(1, "u", "a", 1), (1, None, "", 0), (None, "u", "", 0)]
    assert H.extract_pages(pages.limit(0)).count() == 0


def test_ratios_alone(spark, sf_small):
    """Every class and id renamed at random, and pages of div alone: the same words kept and dropped."""
    rng, kept, dropped = random.Random(3), 0, 0
    for r in spark.read.parquet(f"{sf_small}/pages.parquet").limit(60).collect():
        renamed = re.sub(r'(class|id)="[^"]*"', lambda m: f'{m[1]}="x{rng.randrange(10**6)}"', r.html)
        assert H.main_text(renamed) == plain(r.html)
        divs = re.sub(r"(</?)(article|nav|footer)>", r"\1div>", renamed)
        want, got = plain(r.html).split(), H.main_text(divs).split()
        kept += sum((Counter(want) & Counter(got)).values())
        dropped += sum((Counter(got) - Counter(want)).values())
        assert Counter(want) - Counter(got) == Counter()
    assert kept > 5_000 and dropped < 0.02 * kept


def test_very_deep_pages():
    took = {}
    for n in (2_000, 20_000):
        page = "<div class=a>" * n + f"<p>{LONG}</p>" + "<b>x</i></p>" * n + "</div>" * n
        began = time.process_time()
        assert H.main_text(page).startswith(LONG)
        assert H.main_text("<div>" * n + LONG) == LONG.strip()
        assert H.main_text("<div class=sidebar>" * n + LONG) == LONG.strip()
        took[n] = time.process_time() - began
    assert took[20_000] < 15 * max(took[2_000], 0.2)


@pytest.mark.parametrize("start", ["<!--", "<script>", "<a href='", "<p class=x "])
def test_markup_without_an_end(start):
    began = time.process_time()
    assert H.main_text(f"<p>{LONG}</p>" + start + "a<b " * 1_000_000) == LONG.strip()
    assert time.process_time() - began < 10


@pytest.mark.parametrize("page", [
    "<main><h1>Headline</h1><article><p>{0}</p><p>{0}</p></article></main>", "<div><h1>Headline</h1><article><p>{0}</p><p>{0}</p></article></div>",
    "<header><h1>Site</h1></header><main><h2>Section</h2><div><h1>Headline</h1></div><article><p>{0}</p><p>{0}</p></article><h2>More</h2></main>",
    "<main><h1>Site</h1><article><h1>Headline</h1><p>{0}</p><p>{0}</p></article></main>",
])
def test_headline_beside_an_article(page):
    assert H.main_text(page.format(LONG)) == " ".join(["Headline", LONG.strip(), LONG.strip()])


def test_very_many_articles():
    took = {}
    for n in (2_000, 20_000):
        page = "<main>" + f"<article><p>{LONG}</p></article>" * n + "</main>"
        began = time.process_time()
        assert len(H.main_text(page)) == n * (len(LONG.strip()) + 1) - 1
        took[n] = time.process_time() - began
    assert took[20_000] < 15 * max(took[2_000], 0.2)
