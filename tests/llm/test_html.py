import itertools
import random
import re
from html import unescape

import pytest

from listenlab.llm import html_extract as H
from listenlab.llm import queries

PAGE = """<html><head><title>T</title></head><body class="home page"><header id="top"><h1>Site</h1><a href=x>Home</a></header>
<div class="cookie-notice">We use cookies to make this site better. Accept them all.</div><div id="content"><div class="post"><h1>A headline</h1>
<p>First paragraph of the story, with <a href="#">a link</a> and an &eacute;&nbsp;entity. It goes on for some time.</p>
<div class="ad-slot">Buy now! It is a very good product, you know.</div><p>Short.</p><ul><li>One item of a list<li>another one</ul>
<p>5 < 6 &amp; 7 > 2, unclosed <b>bold<p>Last paragraph,<br>and good night to you all.</div><script>var x = "</p><p>not text</p>";</script>
<form><label>Name</label><input><button>Send it now please</button></form><div id="comments"><h3>Comments</h3>
<p>I really like this article, it is very well written indeed.</p></div></div>
<aside><h2>Related</h2><p>Other stories that you might like to read some day, perhaps.</p></aside>
<div class="sidebarRight"><p>Some long text in the side bar that goes on and on.</p></div><footer>&copy; me.</footer></body></html>"""


def test_article_of_a_page():
    assert H.main_text(PAGE).split("\n") == [
        "A headline", "First paragraph of the story, with a link and an é entity. It goes on for some time.", "Short.",
        "One item of a list", "another one", "5 < 6 & 7 > 2, unclosed bold", "Last paragraph, and good night to you all."]


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("<nav><a href=x>Home</a></nav>", ""), ("<article><p>a", "a"),
    ("<article><p>One.</p><script>never closed <p>x</p>", "One."), ("<!-- open <p>x", ""), ("<article><p title='a>b'>Yes.</p></article>", "Yes."),
    ("<article><p hidden>No.</p><p>" + "x" * 100000 + "</p></article>", "x" * 100000),
    ("<main><table><tr><td>a<td>b<tr><td>c</table><p>Some words follow here.</main>", "a b\nc\nSome words follow here."),
])
def test_odd_pages(html, text):
    assert H.main_text(html) == text


@pytest.mark.parametrize("tag", ["select", "object", "canvas", "svg", "iframe", "noscript", "audio", "video", "template", "datalist"])
def test_only_the_tag_of_an_unclosed_element_goes(tag):
    page = f"<article><p>One sentence here.</p><{tag} id=x><p>Two sentences here.</p><{tag}><p>Three of them.</p></article>"
    assert H.main_text(page) == "One sentence here.\nTwo sentences here.\nThree of them."
    assert "gone" not in H.main_text(f"<article><p>One sentence here.</p><{tag}>gone</{tag}><p>Two sentences here.</p></article>")


def test_letters_that_grow_in_lower_case_shift_nothing():
    page = "<article><p>First sentence here.</p>" + "İ" * 40 + "<SCRIPT>var x = '<p>no</p>';</ScRiPt ><p>Second sentence here.</p></article>"
    assert H.main_text(page).split("\n") == ["First sentence here.", "İ" * 40, "Second sentence here."]


def test_deep_pages_take_time_in_proportion():
    import time

    def seconds(page):
        start = time.perf_counter()
        text = H.main_text(page)
        return time.perf_counter() - start, text

    for one in ("<div>", "<span>", "<div><span>", "<span><p>x</p>"):
        page = lambda n: "<article><p>One sentence here.</p>" + one * n + "<p>The end of it all.</p>"  # noqa: E731,B023
        small, _ = seconds(page(10_000))
        large, text = seconds(page(100_000))
        assert text.startswith("One sentence here.") and text.endswith("The end of it all.") and large < 40 * small + 1


@pytest.mark.parametrize("page, text", [
    ('<main id="main-legal"><p>The terms of this service are plain.</p></main>', "The terms of this service are plain."),
    ('<div class="entry"><div class="entry-header"><h1>The headline of it</h1></div><p>A sentence of the story follows here.</p></div>',
     "The headline of it\nA sentence of the story follows here."),
    ('<div class="post"><p>A sentence of the story follows here, long enough.</p><ol class="commentlist"><li>I do not agree with that at all.</li></ol></div>',
     "A sentence of the story follows here, long enough."),
    ('<div class="page"><div class="page-header"><p>Welcome to our site, dear reader.</p></div><p>A sentence of the story follows here.</p><p>It is followed by '
     'another one, which goes on for a while.</p></div>',
     "A sentence of the story follows here.\nIt is followed by another one, which goes on for a while."),
    ('<body><div id="wrap"><div id="nav"><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></div><h1>A title of a page</h1><p>It has no article '
     'element, but it has sentences of some length.</p><p>And another one of them, too.</p><div id="footer">All rights reserved.</div></div></body>',
     "A title of a page\nIt has no article element, but it has sentences of some length.\nAnd another one of them, too."),
])
def test_pages_without_an_article_element(page, text):
    assert H.main_text(page) == text


def test_formulas_are_text():
    assert H.main_text("<article><p>It is <math><mi>x</mi><mo>=</mo><mn>2</mn></math> in the end.</p></article>") == "It is x=2 in the end."


def test_cut_is_minimal():
    random.seed(11)
    for _ in range(150):
        n = random.randint(1, 9)
        odds = [random.uniform(-2, 2) for _ in range(n)]
        edges = {(a, b): random.uniform(0, 1.5) for a, b in itertools.combinations(range(n), 2) if random.random() < 0.5}

        def cost(labels):
            return (sum(o if not x else 0 for o, x in zip(odds, labels) if o > 0)
                    + sum(-o if x else 0 for o, x in zip(odds, labels) if o < 0)
                    + sum(c for (a, b), c in edges.items() if labels[a] != labels[b]))

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(H.minimum_cut(odds, edges)) - best) < 1e-9


def test_query_gives_the_article_of_every_page(spark):
    got = {r["page_id"]: r for r in queries.op5_html_extraction(spark, "/root/testdata/sf0.01").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        inner = re.search(r"<article>(.*?)</article>", page["html"], re.S).group(1)
        parts = [" ".join(unescape(re.sub(r"<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        r = got[page["page_id"]]
        assert r["text"] == "\n".join(x for x in parts if x) and r["n_chars"] == len(r["text"]) and r["url"] == page["url"]


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, PAGE, "t", 5), (1, None, PAGE, "t", 5), (None, "u", None, None, None), (2, "u", "", "x", 1)]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r["n_chars"] for r in got.collect()) == [0, 0, len(H.main_text(PAGE)), len(H.main_text(PAGE))]
    assert H.extract(spark.createDataFrame([], "html string, k long")).count() == 0
