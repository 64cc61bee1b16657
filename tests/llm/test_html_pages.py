"""Pages unlike the supplied ones: no article, names within longer class and id values."""

from __future__ import annotations

import time

import pytest

from medlattice.llm.html_extract import main_text

LONG = ("Words in a row that make a paragraph long enough to look like prose. " * 4).strip()
OTHER = "A second part of the same text, shorter than the first but prose as well and not to be lost."
MENU = "<ul class='main-nav menu'><li><a href=a>Home</a><li><a href=b>News</a></ul>"
FOOT = f"<div id='site-footer' class='box'><p>{OTHER}</p></div>"
CASES = [
    (f"<div id=content><div>{'nine ' * 180}</div><div>{'one ' * 25}</div></div>", [("nine " * 180).strip(), ("one " * 25).strip()]),
    (f"<body>{MENU}<div id=content><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div><p>{OTHER}</p></div></div>{FOOT}</body>", [LONG, LONG, LONG, OTHER]),
    (f"<article><header class=entry-header><h1>Title</h1></header><p>{LONG}</p></article>", ["Title", LONG]),
    (f"<article><div class=header><h1>Title</h1></div><p>{LONG}</p></article>", ["Title", LONG]),
    (f"<body>{MENU}<div class='content has-sidebar'><h1>T</h1><p>{LONG}</p></div></body>", ["T", LONG]),
    (f"<body><div class='with-menu'><article><p>{LONG}</p><p>End</p></article></div></body>", [LONG, "End"]),
    (f"<article><p>{LONG}</p><section id=social-impact><p>{OTHER}</p></section><h2 id=related-work>Work</h2><p>{LONG}</p></article>", [LONG, OTHER, "Work", LONG]),
    (f"<article><p>{LONG}</p><section id=search><h2 id=comments>Search</h2><p>{OTHER}</p></section></article>", [LONG, "Search", OTHER]),
    (f"<body><div class='page widget'><h1>T</h1><p>{LONG}</p><p>{LONG}</p><div class=ad>{OTHER}</div></div></body>", ["T", LONG, LONG]),
    (f"<article><p>{LONG}</p><p>{LONG}</p><div class='cookie-banner'>{OTHER}</div><div class='share-buttons'>{OTHER}</div><div id=comments><p>{OTHER}</p></div></article>", [LONG, LONG]),
]

#: adverts, notices, reader comments and links to other pages, by class and by id
ASIDE = [
    "<div class=ad-slot>{}</div>", "<div class='google-ad-unit'>{}</div>", "<div class=reader-comments><p>{}</p></div>", "<div class=privacy-notice>{}</div>",
    "<div class=related-articles>{}</div>", "<section id=comments><p>{}</p></section>", "<section id=newsletter>{}</section>", "<div id=user-comments><div><p>{}</p></div></div>",
]


@pytest.mark.parametrize("aside", ASIDE)
@pytest.mark.parametrize("frame", ["<article><p>{0}</p>{1}<p>{0}</p></article>", "<body><div class=content><p>{0}</p>{1}<p>{0}</p></div></body>", "<body><div id=main><p>{0}</p><p>{0}</p></div>{1}</body>"])
def test_what_is_not_the_article_goes(aside, frame):
    assert main_text(frame.format(LONG, aside.format(OTHER))) == f"{LONG}\n\n{LONG}"


def test_hostile_pages_take_time_in_proportion():
    """Deep nesting, unclosed elements, stray end tags and named parts within each other."""
    pages = ["<div>" * 40_000 + LONG, "<section class=x>" * 20_000 + LONG + "</p>" * 20_000, "<div class=ad>" * 20_000 + LONG, "<td><li>" * 20_000 + LONG + "</article>" * 20_000]
    started = time.perf_counter()
    assert [main_text(p) for p in pages] == [LONG, LONG, "", LONG]
    assert time.perf_counter() - started < 20


@pytest.mark.parametrize("case", CASES)
def test_pages(case):
    page, blocks = case
    assert main_text(page) == "\n\n".join(blocks)
