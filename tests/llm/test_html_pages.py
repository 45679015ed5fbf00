"""Pages of other sites, and pages made to stall a parser."""

import time

import pytest

from carelake.llm import html_text

LONG = "A paragraph of many words that stands in the middle of the page, and it goes on for quite a while."
OTHER = "Another paragraph with many other words, which also stands in the page and also goes on for long."


def text_of(page):
    return html_text.main_text(page).split("\n")


def test_a_form_around_the_whole_page_is_no_form():
    menu = "<nav><a href=/>Home</a></nav>"
    page = f"<body><form action=x>{menu}<div><h1>Title</h1><p>{LONG}</p><p>{OTHER}</p></div><input></form></body>"
    assert text_of(page) == ["Title", LONG, OTHER]
    assert text_of(f"<body><form>{menu}<article><h1>T</h1><p>{LONG}</p></article></form>") == ["T", LONG]
    inner = f"<body><article><h1>T</h1><p>{LONG}</p><form><p>Your mail, please</p></form></article>"
    assert text_of(inner) == ["T", LONG]


def test_an_article_beside_is_not_the_article():
    page = f"<body><aside><article><p>Read this teaser too, it is short.</p></article></aside><main><p>{LONG}</p><p>{OTHER}</p></main>"
    assert text_of(page) == [LONG, OTHER]
    assert text_of(f"<body><aside><div><p>{LONG}</p><p>{OTHER}</p></div></aside>") == [LONG, OTHER]


def test_a_main_with_several_articles_and_a_title_before():
    page = f"<main><article><h2>One</h2><p>{LONG}</p></article><article><h2>Two</h2><p>{OTHER}</p><p>{LONG}</p></article></main>"
    assert text_of(page) == ["One", LONG, "Two", OTHER, LONG]
    assert text_of(f"<main><h1>Title</h1><article><p>{LONG}</p></article></main>") == ["Title", LONG]
    aside = f"<main><h1>Title</h1><article><p>{LONG}</p></article><div class=related><h3>More</h3><article>x</article></div><h2>Later</h2><p>y</p></main>"
    assert text_of(aside) == ["Title", LONG, "Later", "y"]


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "deep",
        "<b>" * 100_000 + "deep",
        "<p><span>" * 50_000 + "deep",
        "<ul>" + "<b>" * 50_000 + "<li></li>" * 50_000 + "deep",
        "<i><div>" + "<b>" * 50_000 + "</i>" * 50_000 + "deep",
        "<div>" * 50_000 + "</x>" * 50_000 + "deep",
        "<table><tr><td>" * 30_000 + "deep",
        "<" * 200_000 + "deep",
        "<a b='" * 50_000 + "deep",
        "&amp" * 100_000 + "<!--" * 50_000,
    ],
)
def test_hostile_pages_take_no_longer_than_others(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 5
