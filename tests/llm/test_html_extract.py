from __future__ import annotations

import html
import re

import pytest

from medlattice.llm.html_extract import extracted, main_text

LONG = "Words in a row that make a paragraph long enough to look like prose. " * 4
CASES = [
    (f"<nav><a href=x>Home</a> <a href=y>News</a></nav><article><h1>Title</h1><p>{LONG}<p>{LONG}</article><footer>&copy; x</footer>", ["Title", LONG, LONG]),
    (f"<body><div id=header>Site</div><div class='main'><h2>T</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div class='sidebar'><p>{LONG}</p></div></body>", ["T", LONG, "Short.", LONG]),
    (f"<article><p>a &amp; b &lt;c&gt; &#233;&nbsp;x<br>y</p><script>var t='</p>{LONG}';</script><p>{LONG}</p><div class='comments'><p>{LONG}</p></div></article>", ["a & b <c> é x y", LONG]),
    (f"<main><p>{LONG}</p><form><label>Name</label><input><p>{LONG}</p></form><aside>{LONG}</aside><p style='display:none'>{LONG}</p><p>End</p></main>", [LONG, "End"]),
    (f"<div class=ad>{LONG}{LONG}</div><article><p class='ad'>{LONG}<p>Tiny</article>", ["Tiny"]),
    ("plain text without a tag", ["plain text without a tag"]),
    ("<nav>only menu</nav>", []), ("", []), (None, []), ("<p></p></div></section><", ["<"]), ("<!-- x --><style>p{}</style>", []),
    (f"<header>Site</header><article class='post comment-open'><header><h1>Head</h1></header><section><p>{LONG}</p></section><section><p>Tail</p></section></article>", ["Head", LONG, "Tail"]),
]


@pytest.mark.parametrize("case", CASES)
def test_cases(case):
    page, blocks = case
    assert main_text(page) == "\n\n".join(b.strip() for b in blocks)


def test_supplied_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in extracted(pages).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)</article>", page["html"], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        row = got[page["page_id"]]
        assert row["text"] == "\n\n".join(b for b in blocks if b) and row["n_chars"] == len(row["text"]) and row["url"] == page["url"]


def test_awkward_and_empty(spark):
    rows = [(1, "u", "<p>x</p>", "t"), (1, "u", "<p>x</p>", "t"), (None, None, None, None), (2, "", "", ""), (3, "v", "<p>" + "y " * 300_000, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"] or 0, r["n_chars"]) for r in extracted(pages).collect()))
    assert got == [(0, 0), (1, 1), (1, 1), (2, 0), (3, 599_999)]
    assert extracted(pages.limit(0)).count() == 0
