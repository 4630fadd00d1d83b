"""Main text of pages against the template of the given pages, and hard markup."""

import html
import re

import pyarrow.parquet as pq
import pytest

from daypulse.llm import html_text as H
from tests.conftest import SF_SMALL

LONG = "Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor. " * 4
L = LONG.strip()


def by_template(page):
    """What stands in the one <article> of a given page, cut at its p and h1."""
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark):
    rows = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()
    got = H.op12_html_extraction(spark, spark.read.parquet(f"{SF_SMALL}/pages.parquet")).collect()
    assert sorted((r.page_id, r.url, r.text, r.n_chars) for r in got) == sorted(
        (r["page_id"], r["url"], by_template(r["html"]), len(by_template(r["html"]))) for r in rows)


PAGES = {
    "no article element": (
        f"<body><div id=top><a href=/>Home</a> <a href=/x>Shop</a></div><div class=content><h1>Title</h1><p>{L}"
        f"<p>Short.</p><p>{L}</p></div><div class=right><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>"
        f"<div id=footer>(c) 2020</div></body>", f"Title\n{L}\nShort.\n{L}"),
    "adverts, sidebars, comments, notices": (
        f"<main><h1>T</h1><p>{L}</p><div class='ad-slot'>Buy {L}</div><p>End</p></main><aside><p>{L}</p></aside>"
        f"<section id=comments><p>{L}</p><p>{L}</p></section><div class=cookie-notice>We use {L}</div>", f"T\n{L}\nEnd"),
    "comments by their heading": (
        f"<article><p>{L}</p><section><h2>Comments (2)</h2><p>{L}</p></section></article>", L),
    "a class that speaks of something else": (f"<div class='has-sidebar'><p>{L}</p><p>x</p></div>", f"{L}\nx"),
    "the page inside a form": (f"<form id=f><div><h1>T</h1><p>{L}</p></div></form>", f"T\n{L}"),
    "a form inside the article": (f"<article><p>{L}</p><form><p>Name</p><input></form><p>x</p></article>", f"{L}\nx"),
    "a menu left open": (f"<nav><ul><li><a href=a>A</a><article><p>{L}</p><p>x</p></article>", f"{L}\nx"),
    "cut inside a tag": (f"<article><p>{L}</p><p>end <b>bo</b><a hre", f"{L}\nend bo"),
    "cut inside a comment": (f"<article><p>{L}</p><!-- foo <p>x</p>", L),
    "declarations": (f"<![foo[ x ]]><!DOCTYPE html><article><p>{L}</p><![CDATA[ y ]]><?php 1 ?><p>x</p></article>",
                     f"{L}\nx"),
    "scripts with markup": (f"<article><p>{L}</p><script>x='</article><p>no'</script><style>p{{}}</style><p>x</p></article>",
                            f"{L}\nx"),
    "headers": (f"<header><h1>Site</h1><p>{L}</p></header><article><header><h1>Art</h1></header><p>{L}</p>"
                f"<footer>by me</footer></article><footer>{L}</footer>", f"Art\n{L}"),
    "references and white space": (
        f"<article><p>{L}</p><p> a&amp;b &eacute;&#8212;&#x41;&nbsp; c\n\t d<br>e &lt;b&gt; &am &quot</p></article>",
        f"{L}\na&b é—A c d e <b> &am \""),
    "a table": (f"<table><tr><td><a href=1>m</a><td><p>{L}</p><p>x</p></table>", f"{L}\nx"),
    "an article among articles": (f"<article><p>teaser</p></article><article><p>{L}</p><p>x</p></article>", f"{L}\nx"),
    "no markup": ("just  text\n &amp; more", "just text & more"),
    "menus alone": ("<nav><a href=1>x</a></nav>", ""),
    "nothing": ("", ""), "null": (None, ""), "white space": (" \n ", ""), "an open tag": ("<", "<"),
}


@pytest.mark.parametrize("name", PAGES)
def test_hard_pages(name):
    page, want = PAGES[name]
    assert H.main_text(page) == want


def test_rows(spark):
    rows = [(1, "u", f"<p>{L}</p>", "x"), (1, "u", f"<p>{L}</p>", "x"), (None, None, None, None), (2, "v", "", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, H.op12_html_extraction(spark, df).collect()), key=str)
    assert got == sorted([(1, "u", L, len(L))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert H.op12_html_extraction(spark, df.limit(0)).collect() == []


@pytest.mark.parametrize("page", ["<div>" * 20000 + "<p>y" * 5000, "<b>" * 20000 + "t " * 20000, "<" * 50000,
                                  "<ul>" + "<li>a" * 20000, "<!--" * 20000, "<script>" * 20000, "&" * 50000])
def test_long_broken_pages_end(page):
    H.main_text(page)


def test_threshold_parts_two_clusters():
    import numpy as np
    values = np.array([0.5, 1, 2, 1, 80, 120, 90, 1])
    assert (np.log1p(values) > H.threshold(values)).tolist() == [False] * 4 + [True] * 3 + [False]
    assert H.threshold(np.array([3.0])) == np.log1p(3.0)
