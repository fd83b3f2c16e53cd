"""Main text of pages made by hand and of every page of a test table."""

from __future__ import annotations

import html
import re
import time
from pathlib import Path

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from epilake.llm import main_text as main_text_module
from epilake.llm.main_text import extract, main_text

LONG = "A paragraph of the article with enough words in it to be taken for text, and then some more words."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("no markup at all", "no markup at all"),
        ("<p>a<p>b", "a\n\nb"),
        (f"<div id=menu><a href=/>Home</a></div><p>{LONG}</p><p>Short.</p><div class='cookie-bar notice'>{LONG}</div>", f"{LONG}\n\nShort."),
        (f"<nav>{LONG}</nav><header>{LONG}</header><main><h1>T</h1><p>x</p></main><footer>{LONG}</footer>", "T\n\nx"),
        (f"<article><header><h1>T</h1></header><p>x</p><aside>{LONG}</aside><p>y</p><form>{LONG}</form></article>{LONG}", "T\n\nx\n\ny"),
        (f"<article><p>x</p></article><section class=comments><p>{LONG}</p></section>", "x"),
        ("<article><p>a &lt;b&gt; &amp;amp; &eacute;&#233;&#x1F600; &nbsp;c\n\t d</p></article>", "a <b> &amp; éé😀 c d"),
        ("<article>a<!-- <p>no</p> -->b<script>if (a<b) '</p>'</script>c<style>p{}</style>d<br>e</article>", "abcd e"),
        (f"<nav><ul><li>x<article><p>{LONG}</p></article>", LONG),
        (f"<p title='a>b'>{LONG}</p><ul><li><a href=1>one</a><li><a href=2>two</a></ul>", LONG),
        (f"<div class=main-content sidebar-left><p>{LONG}</p></div><div class=sidebar><p>{LONG}</p></div><foot", LONG),
        (f"<p>{LONG}</p><p class=ad>{LONG}<p>{LONG}</p><div hidden>no</div>", f"{LONG}\n\n{LONG}"),
        ("<article>1 < 2 and 3 > 2</article>", "1 < 2 and 3 > 2"),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


LINKS = "<ul>" + "<li><a href=/>a link</a>" * 5 + "</ul>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div><p>{LONG}</p><div class=ad><p>Buy</p></div><p>Short end.</p></div>", f"{LONG}\n\nShort end."),
        (f"<div><p>{LONG}</p></div></div><div><div><p>One.</p></div></div><div><div><p>Two.</p></div></div>", f"{LONG}\n\nOne.\n\nTwo."),
        (f"<p>{LONG}</p><table><tr><td>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr></table>", f"{LONG}\n\na\n\nb\n\nc\n\nd"),
        (f"<div><h1>T</h1></div><div><p>By N.</p></div><div><p>May.</p></div><p>{LONG}</p>", f"T\n\nBy N.\n\nMay.\n\n{LONG}"),
        (f"<div><p>{LONG}</p>{LINKS}<p>End.</p></div>{LINKS}<div>Imprint</div>", "\n\n".join([LONG, *["a link"] * 5, "End."])),
    ],
)
def test_blocks_between_surges_without_an_article(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div><p>{LONG}</p><p>{LONG}</p><p>End.</p></div><article>Card</article>", f"{LONG}\n\n{LONG}\n\nEnd.\n\nCard"),
        (f"<div><p>{LONG}</p><p>{LONG}</p><article>Card</article><p>End.</p></div>", f"{LONG}\n\n{LONG}\n\nCard\n\nEnd."),
        (f"<div>Slogan</div><article><h1>T</h1>{LINKS}<p>x</p></article><div>{LONG}</div>", "\n\n".join(["T", *["a link"] * 5, "x"])),
    ],
)
def test_an_article_is_a_weight(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article>x</article><section class=comments><article class=comment><p>{LONG}</p></article></section>", "x"),
        (f"<div><p>{LONG}</p></div><aside><article class=teaser><p>{LONG}</p></article></aside>", LONG),
        (f"<p>{LONG}</p><article class=comment><p>{LONG}</p><article class=comment>{LONG}</article></article><p>End.</p>", f"{LONG}\n\nEnd."),
        (f"<ol><li class=comment><article>{LONG}</article><ul><li>{LONG}<li>x</ul></li></ol><main>x</main>", "x"),
        (f"<article class='post tag-search category-notices'>{LONG}</article>", LONG),
        (f"<form id=page><nav>{LONG}</nav><article>{LONG}</article></form>", LONG),
        (f"<div><aside>{LONG}</div><article>x</article><aside>{LONG}</aside>", "x"),
        (f"<li><ul><li class=ad>{LONG}</ul><p>{LONG}</p></li><div class=ad /><p>End.</p>", f"{LONG}\n\nEnd."),
        (f"<p class=ad>{LONG}<div class=ad>{LONG}</div>{LONG}", LONG),
    ],
)
def test_dropped_elements_end_at_their_end_tags(page, text):
    assert main_text(page) == text


def test_every_page_of_a_table_without_articles(spark):
    pages = spark.read.parquet(str(Path("/root/testdata/sf0.01/pages.parquet")))
    plain = pages.withColumn("html", F.expr("replace(replace(html, '<article>', '<div>'), '</article>', '</div>')"))
    texts = [{r.page_id: r.text for r in extract(rows).collect()} for rows in (pages, plain)]
    assert texts[0] == texts[1]


def test_long_and_broken_pages_take_linear_time():
    assert main_text("<p " + "a='" * 50_000) == ""
    assert main_text("<" * 100_000).startswith("<")
    assert main_text("<article>" + "<div>" * 20_000 + "x") == "x"
    words = "word " * 400_000
    assert len(main_text(f"<article><p>{words}</p></article>")) == len(words) - 1


def test_every_page_of_a_table(spark):
    pages = spark.read.parquet(str(Path("/root/testdata/sf0.01/pages.parquet")))
    texts = {r.page_id: r for r in extract(pages).collect()}
    for page in pages.collect():
        inner = page.html[page.html.index("<article>") : page.html.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        expected = "\n\n".join(b for b in blocks if b)
        assert (texts[page.page_id].text, texts[page.page_id].n_chars) == (expected, len(expected))


def test_deep_nesting_takes_linear_time():
    assert main_text("<div class=ad><li>" * 50_000 + "</div>" * 50_000 + LONG) == LONG


def test_missing_repeated_and_extra(spark):
    rows = spark.createDataFrame([(1, None, None), (None, "u", "<p>a"), (None, "u", "<p>a")], "page_id long, url string, html string")
    rows = rows.withColumn("text", F.lit("other")).withColumn("n_chars", F.lit(9))
    assert sorted(tuple(r) for r in extract(rows).fillna(-1).fillna("?").collect()) == [(-1, "u", "a", 1), (-1, "u", "a", 1), (1, "?", "", 0)]
    assert extract(rows.where("false")).collect() == []


STORY = "<div><p>" + "</p><p>".join(f"A paragraph of the story that is long enough to count, number {k}." for k in range(4)) + "</p></div>"
TOLD = "\n\n".join(f"A paragraph of the story that is long enough to count, number {k}." for k in range(4))
MENU = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul>"


def test_a_form_around_the_page_is_no_form():
    field = "<input name=x><button>Go</button><select><option>One</select>"
    assert main_text(f"<body><form id=aspnetForm>{field}<nav>{MENU}</nav>{STORY}</form></body>") == TOLD
    assert main_text(f"<body>{STORY}<form><label>Write to us, we read every word of it and more</label>{field}</form></body>") == TOLD


def test_an_unclosed_menu_ends_where_text_begins():
    assert main_text(f"<body><nav>{MENU}{STORY}</body>") == TOLD
    assert main_text(f"<body><div class=sidebar>{MENU}{STORY}</body>") == TOLD


def test_names_that_are_phrases_are_no_lists_of_kinds():
    rescue = "<div class='search-and-rescue'><p>The rescue took all night, and nobody was hurt in the end of it.</p></div>"
    found = main_text(f"<article>{STORY}{rescue}</article>")
    assert found == TOLD + "\n\nThe rescue took all night, and nobody was hurt in the end of it."
    assert main_text(f"<article>{STORY}<div class='site-search'><p>Search all of our pages for any words at all.</p></div></article>") == TOLD


def test_comment_lists_go():
    comments = "<ol class=commentlist><li><p>I read all of this with great interest, many thanks to you.</p></li></ol>"
    assert main_text(f"<article>{STORY}{comments}</article>") == TOLD
    assert main_text(f"<article>{STORY}</article>{comments}") == TOLD


def test_cards_beside_a_story_are_not_the_article():
    cards = "".join(f"<article><h3><a href=/{k}>Another headline {k}</a></h3></article>" for k in range(6))
    assert main_text(f"<body><div id=x>{STORY}</div><div>{cards}</div></body>") == TOLD
    assert main_text(f"<body><article>{STORY}</article><div>{cards}</div></body>") == TOLD


@pytest.mark.parametrize("piece", ["<script '", "<a href='", "<a href=\"x' ", "<a '\">", "<!--<!", "<x ", "<script>", "</p '"])
@pytest.mark.parametrize("end", ["", ">", "'>", '">'])
def test_broken_quotes_take_linear_time(piece, end):
    page = piece * ((1 << 20) // len(piece)) + end
    start = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - start < 5


@given(st.text(alphabet="<>\"'a/ =!-", max_size=60))
def test_marks_are_followed_as_the_pattern_does(text):
    slow, fast = main_text_module._TagEnds(text), main_text_module._TagEnds(text)
    fast._survey()
    for at in range(len(text) + 1):
        found = main_text_module._QUOTED.match(text, at)
        assert fast.find(at) == (found.end() if found else -1) == slow.find(at)
