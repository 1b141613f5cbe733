"""Main text of pages."""

import html
import re

import pytest

from tillhouse.llm import queries, style_tree
from tillhouse.llm.html_blocks import DROPPED, INSIDE, OUTSIDE, blocks


def texts(page, place=None):
    return [t for _, p, t in blocks(page) if place is None or p == place]


@pytest.mark.parametrize("page, want", [
    ("<p>a  b\n c</p>", ["a b c"]), ("a<b>b</b>c", ["abc"]), ("<p>a<br>b<p>c", ["a", "b", "c"]),
    ("<p>x &amp; y &lt;b&gt; &copy;&nbsp;z</p>", ["x & y <b> © z"]), ("<script>var a='<p>no</p>';</script><p>yes", ["yes"]),
    ("<style>p{}</style><title>no</title><p title='a>b'>yes</p>", ["yes"]), ("<!-- <p>no</p> --><p>yes</p>", ["yes"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]), ("<p><b>a<p>b</b>c", ["a", "bc"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("a < b and c > d", ["a < b and c > d"]),
    ("<div>a</span>b</div></div>c", ["ab", "c"]), ("<noscript>no</noscript>yes<template>no</template>", ["yes"]),
    ("<p class=\"unclosed>a</p>b", ["<p class=\"unclosed>a", "b"]), (None, []), ("", []), ("<!DOCTYPE html><p>a<script>b", ["a"]),
])
def test_blocks(page, want):
    assert texts(page) == want


def test_places():
    page = ("<header><h1>site</h1></header><nav>menu</nav><div class='ad-slot'>buy</div><article><header><h1>title</h1></header>"
            "<p>body<div class='comments'>first!</div><aside>more</aside><form>mail</form><p>end</article><div>other</div><footer>foot")
    assert texts(page, INSIDE) == ["title", "body", "end"]
    assert texts(page, DROPPED) == ["site", "menu", "buy", "first!", "more", "mail", "foot"]
    assert texts(page, OUTSIDE) == ["other"]


@pytest.mark.parametrize("page", [
    "<form id=aspnetForm><div><article><p>story</p></article></div><input></form>", "<div class='post comments-open'><article>story</article></div>",
    "<section class='social-layout'><article>story</article></section>", "<article class='share-enabled'>story</article>",
    "<form><main>story</main>menu</form>", "<article><p title=don't>story</p></article><p>It's beside",
    "<article><a href=\"x\"\">story</a></article>", "<article><p hidden-xs>story</p><div class='x' hidden>no</div><p hidden='until-found'>no</article>",
    "<article>story<form>your mail</form><div class='comments'><article>first!</article></div></article>",
    "<article>story</article><div id='comments'><ol class='comment-list'><li><article>first!</article></ol></div>"])
def test_articles_are_found_whatever_stands_round_them(page):
    assert texts(page, INSIDE) == ["story"]


def test_forms_and_headers_of_pages_without_marks(spark):
    assert texts("<form><p>a long story of this page</p></form><p>menu</p>", OUTSIDE) == ["a long story of this page", "menu"]
    assert texts("<p>a long story of this page</p><form>your mail</form>", OUTSIDE) == ["a long story of this page"]
    rows = [(i, f"http://a.example/{i}", f"<header>Our site</header><div class=post><header><h1>Title {i}</h1></header><p>story {i}</p></div>"
             "<form>Write to us</form>") for i in range(12)]
    assert main_texts(spark, rows)[3] == "Title 3 story 3"


def test_op6_against_the_pages_articles(spark, folder):
    got = {r.page_id: r for r in queries.op6_site_style_tree(spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        inside = re.search("<article>(.*?)</article>", page.html, re.DOTALL)[1]
        inside = re.sub(r"</?(p|div|h1|br|ul|li)\b[^>]*>", " ", inside)
        want = " ".join(html.unescape(re.sub("<[^>]*>", "", inside)).split())
        assert (got[page.page_id].text, got[page.page_id].n_chars, got[page.page_id].url) == (want, len(want), page.url)


def test_repeated_branches_go_by_entropy(spark):
    rows = []
    for i in range(12):
        rows.append((i, f"http://a.example/{i}", f"<body><div class='x'>Welcome to our site</div><div class='main-col'><p>story {i} of "
                        f"today</p><p>it goes on {i * 7}</p></div><div class='y'><p>Call us</p></div></body>"))
    rows += [(100, "http://b.example/1", "<body><div class='x'>Welcome to our site</div><p>alone</p></body>")]
    rows += [(200 + i, "http://c.example/same", "<body><div>equal</div><p>pages</p></body>") for i in range(9)]
    got = {r.page_id: r.text for r in style_tree.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "story 3 of today it goes on 21"
    assert got[100] == "Welcome to our site alone"
    assert got[205] == "equal pages"  # equal pages are one page, and that is too few to tell


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "not a url", ""), (3, "http://x.example/", "<p>" * 3000 + "deep"), (4, None, "<p>t</p>"), (4, None, "<p>t</p>"),
            (None, "http://x.example/", "plain")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' AS id", "1 AS host", "2 AS text")
    got = sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in style_tree.main_text(df).collect())
    assert [g[2] for g in got] == ["plain", "", "", "deep", "t", "t"] and [g[3] for g in got] == [5, 0, 0, 4, 1, 1]
    assert style_tree.main_text(df.limit(0)).count() == 0


def main_texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in style_tree.main_text(pages).collect()}


def test_marks_are_a_prior_that_entropy_can_overrule(spark):
    rows = [(i, f"http://a.example/{i}", f"<main><div class='x'>Welcome to our site</div><p>story {i}</p><div class='y'>Call us</div></main>")
            for i in range(12)]
    rows += [(100 + i, f"http://b.example/{i}", f"<div class='long'>a long story {i}</div><div class='z'>Imprint</div><article>see {i} too"
              "</article>") for i in range(12)]
    rows += [(200, "http://c.example/1", "<main><div class='x'>Welcome</div><p>alone</p></main><p>beside</p>")]
    got = main_texts(spark, rows)
    assert got[3] == "story 3" and got[103] == "a long story 3 see 3 too"
    assert got[200] == "Welcome alone"  # one page tells nothing, so the mark decides


@pytest.mark.parametrize("name", ["layout with-sidebar", "no-sidebar", "elementor-widget", "has-menu", "post-notice", "has-comments"])
def test_content_in_a_named_wrapper_is_kept(name):
    page = f"<div class='{name}'><article><p>story</p><div class='comments'><article>first!</article></div></article></div>"
    assert texts(page, INSIDE) == ["story"]
    assert texts("<div class='social-layout'><main>story</main></div><nav><main>menu</main></nav>", INSIDE) == ["story"]


def test_counts_overrule_names(spark):
    rows = [(i, f"http://a.example/{i}", f"<div class='text-widget'><p>story {i}</p></div><div class='sidebar'>About us</div>"
             f"<div class='comments'>comment {i}</div><div class='ad'>buy {i}</div>") for i in range(12)]
    rows += [(100, "http://b.example/1", "<div class='text-widget'><p>story</p></div><p>more</p>")]
    got = main_texts(spark, rows)
    assert got[3] == "story 3" and got[100] == "more"
