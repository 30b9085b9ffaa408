"""Main text of pages of several shapes."""

import html
import random
import re

from edupipe.llm.main_text import extract, main_text
from edupipe.llm.queries import op7
from edupipe.llm.queries import table as read_table

PARAGRAPHS = [
    "The first paragraph says what the whole article is about, with <b>bold</b> words and a <a href='/x'>link</a> inside.",
    "The second\n   paragraph has &amp; and &eacute;&nbsp;and &#8364; and goes on for a while so that it is long enough.",
    "The third one is short.",
]
PLAIN = [
    "The first paragraph says what the whole article is about, with bold words and a link inside.",
    "The second paragraph has & and é and € and goes on for a while so that it is long enough.",
    "The third one is short.",
]
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>Section {i}</a></li>" for i in range(9)) + "</ul>"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>Title</title>{head}</head><body>{body}</body></html>"


def paragraphs():
    return "".join(f"<p>{p}</p>" for p in PARAGRAPHS)


def test_article_among_everything_else():
    text = main_text(page(
        "<header><h1>Site</h1></header><nav>" + MENU + "</nav><div class='cookie-notice'>We use cookies. " + "Really. " * 40 + "</div>"
        "<div id='sidebar'>" + MENU + "</div><article><h1>A title</h1>" + paragraphs() + "<div class='ad'>Buy " + "things " * 90 + "</div>"
        "<form><p>Your name <input name=a> <button>Send</button></p></form><script>if (a < b) { x = '<p>no</p>' }</script><style>p{}</style></article>"
        "<section class='comments'><p>" + "A reader says a lot. " * 60 + "</p></section><footer>&copy; 2026</footer>",
        "<style>p > a {}</style>",
    ))
    assert text == "\n".join(["A title", *PLAIN])


def test_density_finds_the_core_without_an_article_element():
    text = main_text(page(
        "<div><a href=/>Home</a> <a href=/a>About us</a> <a href=/b>Contact</a></div><div class='x1'>" + MENU + "</div>"
        "<div class='c'><h2>Heading</h2><div>" + paragraphs() * 3 + "</div></div><div>" + MENU + "</div>"
    ))
    assert text == "\n".join(["Heading", *PLAIN * 3])


def test_classes_of_layout_and_of_article_parts():
    text = main_text(page(
        "<div class='page sidebar-right'><main class='has-sidebar'><article class='post'><header class='entry-header'><h1 class='page-header'>A title</h1></header>"
        + paragraphs() + "<footer class='entry-footer'><p>Filed under things</p></footer></article>"
        "<article class='comment'><p>" + "A reader says a lot. " * 40 + "</p></article></main><div class='widget-area'><p>More</p></div></div>"
    ))
    assert text == "\n".join(["A title", *PLAIN])


def test_paragraphs_straight_in_the_body():
    assert main_text(page(paragraphs())) == "\n".join(PLAIN)
    assert main_text("Just <i>text</i>,\n no body") == "Just text, no body"


def test_unclosed_and_misplaced_tags():
    text = main_text("<article><p>one <b>two<p>three</i> four<ul><li>five<li>six</ul><table><tr><td>a<td>b<tr><td>c</table></article>")
    assert text == "one two\nthree four\nfive\nsix\na\nb\nc"
    assert main_text("<article><p>a < b and <3 <br>new</p></article>") == "a < b and <3 new"
    assert main_text("<article><p title='x > y'>z</p><!-- <p>no</p> --></article><!-- open") == "z"


def test_nothing_to_find(spark):
    assert [main_text(x) for x in (None, "", "  ", "<nav><p>menu</p></nav>", "<script>x", "<", "<!--")] == ["", "", "", "", "", "<", ""]
    rows = [(1, "u", None, 1), (1, "u", "<p>a</p>", 2), (None, None, "<p>b</p>", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    assert sorted((r.page_id is None, r.text, r.n_chars) for r in extract(pages).collect()) == [(False, "", 0), (False, "a", 1), (True, "b", 1)]
    assert extract(pages.limit(0)).collect() == []


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    long = "word " * 200_000
    assert len(main_text(f"<article><p>{long}</p></article>")) == len(long) - 1
    rng = random.Random(1)
    for _ in range(300):
        main_text("".join(rng.choice(["<", ">", "</p>", "<p", "<a href='", '"', "&amp;", "&#x", "x ", "<td>", "</div>", "<div>"]) for _ in range(40)))


def test_op7_whole_table(spark, small):
    pages = {r.page_id: r.html for r in read_table(spark, small, "pages").collect()}
    for row in op7(spark, small).collect():
        article = re.search("<article>(.*)</article>", pages.pop(row.page_id), re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert row.text == "\n".join(b for b in blocks if b) and row.n_chars == len(row.text)
    assert not pages


def test_a_form_around_the_page_is_no_form():
    body = "<div class='menu'><a href='/'>home</a></div><div><p>" + "word " * 60 + "</p><p>" + "more " * 60 + "</p></div>"
    expected = ("word " * 60).strip() + "\n" + ("more " * 60).strip()
    assert main_text(f"<html><body><form action='/p'>{body}</form></body></html>") == expected
    search = "<form><input><p>search for something</p></form>"
    assert main_text(f"<html><body>{search}{body}</body></html>") == expected


def test_the_greatest_sum_decides_among_articles():
    parts = [f"<p>{w} {w * 2} " + f"{w} " * 50 + "</p>" for w in ("one", "two", "six", "ten")]
    page = f"<body><nav><a href='/'>m</a></nav><article>{parts[0]}{parts[1]}</article><article>{parts[2]}{parts[3]}</article><footer>f</footer></body>"
    lines = main_text(page).split("\n")
    assert [line.split()[0] for line in lines] == ["one", "two", "six", "ten"]
