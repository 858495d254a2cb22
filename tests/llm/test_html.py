"""Main text of pages, by hand and on the given pages."""

import time

import html
import re

import pytest

from llm_cases import SF  # noqa: F401

from sparkchecks.llm.html_extract import extract_pages, main_text
from sparkchecks.llm.queries import QUERIES

LONG = "Once upon a time, in a land far away, there was a page with enough text, and commas, to be the article."


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("a &lt; b &amp; c", "a < b & c"),
        (f"<p>{LONG}", LONG),
        (f"<nav><a href=x>Home</a></nav><div class=content><p>{LONG}</p><p>End.</p></div><footer>(c)</footer>", LONG + " End."),
        (f"<header>Site</header><article><header><h1>T</h1></header><p>{LONG}</p></article><aside>x</aside>", "T " + LONG),
        (f"<div id=main><p>{LONG}</p><form><input><label>x</label></form></div><div id=comments><p>{LONG * 3}</p></div>", LONG),
        (f"<div><p>{LONG}<p>two<br>lines</div><div class='cookie-notice'><p>{LONG}</p></div>", LONG + " two lines"),
        (f"<article><p>{LONG}</p><div class='ad'>Buy</div><script>if (a<b) '</p>'</script><style>p{{}}</style></article>", LONG),
        (f"<article><p>a&nbsp;b\n\t c</p><p>{LONG}</p>", "a b c " + LONG),
        (f"<article><p>bro<b>ken</b> <i>x<p>{LONG}</article>", "broken x " + LONG),
        (f"<article><p>{LONG}</p><ul><li><a>one</a><li><a>two</a><li><a>three</a></ul></article>", LONG),
        (f"<article><p>{LONG}</p></article><foo", LONG),
        (f"<p hidden>no</p><p style='display: none'>no</p><p>{LONG}</p>", LONG),
        ("<div>" * 3000 + LONG + "</div>" * 3000, LONG),
        ("<p>" + "x" * 200_000, "x" * 200_000),
        ("<<<>>> <a <b> </", "<<<>>> </"),
    ],
)
def test_main_text(source, text):
    assert main_text(source) == text


def test_a_page_with_all_parts(spark):
    df = spark.createDataFrame([(1, "u", f"<p>{LONG}", "x"), (1, "u", f"<p>{LONG}", "x"), (None, None, None, "x")], "page_id long, url string, html string, text string")
    rows = sorted(extract_pages(df).collect(), key=str)
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in rows] == [(1, "u", LONG, len(LONG))] * 2 + [(None, None, "", 0)]
    assert extract_pages(df.limit(0)).count() == 0


def test_given_pages(spark):
    """The given pages have one article element each: all its text, nothing else."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op1_html_extraction"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", pages[r.page_id], re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", inner))
        assert r.text == " ".join(html.unescape(plain).split())
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (f'<article><p>{LONG} <a href="/hidden-gems">gems</a></p></article>', LONG + " gems"),
        (f'<article><p title="The hidden valley">{LONG}</p></article>', LONG),
        (f'<article><p data-hidden="false" data-role=navigation>{LONG}</p></article>', LONG),
        (f'<div><p><a href="/p?id=nav">see</a> {LONG}</p></div>', "see " + LONG),
        (f'<div><p hidden="">no</p><p HIDDEN=hidden>no</p><p aria-hidden = "true">no</p><p>{LONG}</p></div>', LONG),
        (f'<div class="layout-with-sidebar"><article><p>{LONG}</p></article><div class=sidebar><p>no</p></div></div>', LONG),
        (f'<div class="row sidebar-right"><div><p>{LONG}</p><p>{LONG}</p></div><div class="sidebar"><p>no</p></div></div>', LONG + " " + LONG),
        (f'<body><div class="related"><article><p>{LONG}</p></article></div><article><p>{LONG} It.</p></article></body>', LONG + " It."),
        (f'<body><p>{LONG}</p><div id=comments><p>{LONG * 3}</p></div></body>', LONG),
        (f'<body><div><p>{LONG}</p></div><div id=comments>{"<p>" + LONG}{"<p>" + LONG * 30}</div></body>', LONG),
    ],
)
def test_attributes_and_names_around_the_article(source, text):
    assert main_text(source) == text


ARTICLE = "The harbour was quiet that morning, and the boats lay still, as if they were waiting for a wind that would not come. " * 6


@pytest.mark.parametrize("broken", ["<div>" * 100_000, "<span><a>" * 50_000, "<p><b>" * 50_000, "<ul><li>" * 50_000, "<li>" * 100_000, "<table><tr><td>" * 30_000, "<svg/>" * 100_000, "</div>" * 100_000, "<em>" * 50_000 + "<p>" * 50_000])
def test_deep_and_unclosed_markup_is_read_in_linear_time(broken):
    before = time.process_time()
    text = main_text(f"<html><body><article><p>{ARTICLE}</p></article>{broken}last words")
    assert time.process_time() - before < 20
    assert "harbour" in text


def test_no_text_is_lost():
    wrapped = main_text(f"<body><form action=x><div id=nav><a href=/>Home</a></div><div class=main><p>{ARTICLE}</p><p>{ARTICLE}</p></div><input type=hidden></form></body>")
    assert wrapped.count("harbour") == 12 and "Home" not in wrapped
    inside = main_text(f"<article><p>{ARTICLE}</p><p class='copyright-history'>{ARTICLE}</p><p class='legal-case'>{ARTICLE}</p><p class=copyright>No rights</p></article>")
    assert inside.count("harbour") == 18 and "No rights" not in inside
    dotted = main_text(f"<article><p>{'İ' * 60}</p><SCRIPT>var x = 1;</Script><p>{ARTICLE}</p><style>p {{}}</STYLE><p>the end, truly</p></article>")
    assert dotted.count("harbour") == 6 and "the end" in dotted and "var x" not in dotted
    small = main_text(f"<article><p>{ARTICLE}</p></article><form><p>Sign up, it is free</p><input></form>")
    assert "Sign up" not in small
