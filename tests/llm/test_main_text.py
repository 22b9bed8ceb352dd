"""Main texts of pages of known articles, and of html of every kind."""

from __future__ import annotations

import html
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyworks.llm.main_text import extract_pages, main_text, names_unlikely

SF_DIR = "/root/testdata/sf0.001"
P = ["The quick brown fox, having jumped, rested by the river for a while.",
     "Later, when the sun had set, it went on and crossed the hills & valleys.",
     "Nobody knows, even now, where it slept; some say under an old oak."]
BODY = "".join(f"<p>{html.escape(p)}</p>" for p in P)
WANT = "\n".join(P)
LINKS = "".join(f'<li><a href="/{i}">Section {i}</a></li>' for i in range(8))
LONG = "Great offer, buy now, really cheap, best price in town, do not miss it. " * 12

AROUND = [
    f"<nav><ul>{LINKS}</ul></nav>", f"<div class='menu'><ul>{LINKS}</ul></div>",
    f"<header><h2>Site name</h2><p>{LONG}</p></header>", f"<footer><p>{LONG}</p></footer>",
    f'<div id="footer"><p>{LONG}</p></div>', f"<aside><p>{LONG}</p></aside>",
    f'<div class="sidebar"><p>{LONG}</p></div>', f'<div class="ad"><p>{LONG}</p></div>',
    f'<div class="cookie-notice" role="dialog"><p>{LONG}</p></div>',
    f"<form><p>{LONG}</p><textarea>x</textarea><button>Send</button></form>",
    f"<script>var a = '<p>{LONG}</p>';</script>", f"<style>p {{ }} /* <p>{LONG} */</style>",
    f"<!-- <p>{LONG}</p> -->", f'<section id="comments"><article class="comment"><p>{LONG}</p>'
    f"</article><p>{LONG}</p></section>", f'<p style="display: none">{LONG}</p>',
    f"<noscript><p>{LONG}</p></noscript>", f"<div hidden><p>{LONG}</p></div>",
    f"<div><ul>{LINKS}{LINKS}</ul></div>",
]
ARTICLES = [f"<article>{BODY}</article>", f"<main>{BODY}</main>", f'<div id="content">{BODY}</div>',
            f'<div class="post-content">{BODY}</div>', f"<div><div>{BODY}</div></div>",
            f'<div role="main"><section>{BODY}</section></div>',
            f"<main><article><div>{BODY}</div></article></main>"]


@pytest.mark.parametrize("around", AROUND)
@pytest.mark.parametrize("article", ARTICLES)
def test_parts_around(around, article):
    head = "<!DOCTYPE html><html><head><title>No</title></head>"
    for body in (around + article, article + around, f"<div>{around}{article}</div>"):
        assert main_text(f"{head}<body>{body}</body></html>") == WANT


@pytest.mark.parametrize("inside", [part for part in AROUND if "header" not in part][:-1])
def test_parts_inside(inside):
    page = f"<body><article><p>{html.escape(P[0])}</p>{inside}" + "".join(
        f"<p>{html.escape(p)}</p>" for p in P[1:]) + "</article></body>"
    assert main_text(page) == WANT


@pytest.mark.parametrize("page, want", [
    ("", ""), (" \n", ""), ("plain words", "plain words"), ("a < b &amp; c &lt; d &#233;",
                                                            "a < b & c < d é"),
    ("<p>one<p>two", "one\ntwo"), ("<ul><li>a<li>b</ul>", "a\nb"),
    ("<article><h1>T</h1>bare<p>x<br>y\n\t z&nbsp;w</p>tail</article>",
     "T\nbare\nx y z w\ntail"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"),
    ("<p>half a tag <a href='x", "half a tag"), ("<p>cut &am", "cut &am"),
    ("<p title='a > b'>kept</p>", "kept"), ("<p class=a b=\"c>kept</p>", "kept"),
    ("<P>Up<SCRIPT>x</P></SCRIPT>per</P>", "Upper"), ("<p>a</b></i></div>b</p>", "ab"),
    ("<article><header><h1>T</h1></header><p>x</p></article>", "T\nx"),
    ("<div class='ad'>only an advert</div>", "only an advert"),
    ("<p>in <b>line</b> <span class='ad'>buy</span>mark<i>up</i></p>", "in line markup"),
    ("<body class='has-sidebar no-comments'><p>x</p></body>", "x"),
    ("<div class='with-sidebar'><article><p>x</p></article></div>", "x"),
    ("<div>a<div class='ad'>buy</div>b</div>", "a\nb"), ("<!-- open <p>x</p>", ""), ("a<!-->b<!--c-->d", "abd"), ("</>x</ y>z<?php ?>", "xz"),
    ("<p>&copy; &middot; &zzz; &#x41;</p>", "© · &zzz; A")])
def test_pages(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("value, unlikely", [
    ("ad", True), ("head", False), ("article-header", False), ("main-menu", True), ("ad-1", True),
    ("adBanner", True), ("has-sidebar", False), ("post-content social-enabled", False),
    ("content comments", True), ("shadow loading broad", False), ("user-comments", True)])
def test_names(value, unlikely):
    assert names_unlikely(value) is unlikely


def test_short_article_beside_long_comments():
    page = ("<body><div id='a'><h1>T</h1><p>Short, but the article.</p></div>"
            f"<div class='comments'>{'<p>' + LONG + '</p>' * 9}</div></body>")
    assert main_text(page) == "T\nShort, but the article."


def test_sections_are_kept_whole():
    sections = "".join(f"<section><h2>S{i}</h2><p>{p}</p></section>"
                       for i, p in enumerate(["Short.", LONG.strip(), "Brief, too."]))
    want = "\n".join(["Title", "S0", "Short.", "S1", LONG.strip(), "S2", "Brief, too."])
    for page in (f"<div><h1>Title</h1>{sections}</div>", f"<article><h1>Title</h1>{sections}"):
        assert main_text(page) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["<p>", "</p>", "<div>", "</div>", "<a href=x>", "</a>", "<li>", "<table>", "<td>", "</td>",
     "<b", ">", "<!--", "-->", "<script>", "</script>", "x", "&amp", " ", "<", "'", '"', "=",
     "</", "<article>", "<h1>", "<br>", "<tr>", "</table>", "<ul>", "</ul>", "é"]), max_size=40))
def test_any_tags(parts):
    text = main_text("".join(parts))
    assert text == "\n".join(" ".join(line.split()) for line in text.split("\n"))


def test_time_is_linear():
    for part in ("<b>", "<div>", "<p>x", "</i>", "<a href='", "<!-", "<td>", "<li>x", '<p a="',
                 "&amp;", "< ", "<ul><li>"):
        began = time.process_time()
        main_text(part * 60_000)
        assert time.process_time() - began < 15, part


def plain_article(page):
    """The article element by patterns, for pages whose only mark-up inside is p, h1, b, br."""
    inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>?", " ", block)).split()) for block in blocks]
    return "\n".join(text for text in texts if text)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    rows = pages.collect()
    found = {r.page_id: r for r in extract_pages(pages).collect()}
    assert len(found) == len(rows)
    for row in rows:
        want = plain_article(row.html)
        assert tuple(found[row.page_id]) == (row.page_id, row.url, want, len(want))


def test_odd_rows(spark):
    draw = random.Random(1)
    long = "<article>" + "".join(f"<p>{draw.random()}, é\U0001F600</p>" for _ in range(40_000))
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (None, "u", "<p>a</p>", "x"),
            (3, "u", long, None), (4, None, BODY, "x"), (4, None, BODY, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted(map(tuple, extract_pages(pages).collect()), key=str)
    want = [(i, u, main_text(h), len(main_text(h))) for i, u, h, _ in rows]
    assert found == sorted(want, key=str)
    assert extract_pages(pages.limit(0)).count() == 0
