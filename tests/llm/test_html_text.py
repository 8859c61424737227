"""Main text of pages: the article and nothing around it."""

import html
import re

import pytest

from tabforge.llm import html_text
from tabforge.llm.queries import op11_html_extraction
from tests.llm.conftest import SF


def test_op11_equals_article_of_the_markup(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op11_html_extraction(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]]["html"], re.S).group(1)
        want = " ".join(html.unescape(re.sub("</?(?:p|br|h1)>", " ", inner).replace("<b>", "")).split())
        assert r["text"] == want and r["n_chars"] == len(want) and r["url"] == pages[r["page_id"]]["url"]


LONG = "This paragraph holds enough words of running text to be the main content of its page, without a link. " * 3
MAIN = f"<p>{LONG}</p><p>Short.</p><p>{LONG}</p>"


@pytest.mark.parametrize("page", [
    f"<nav><a href=a>Home</a></nav><article>{MAIN}</article><aside>Other things</aside><footer>(c)</footer>",
    f"<header><h1>Site</h1></header><main>{MAIN}</main><div class='cookie-notice'>{LONG}</div>",
    f"<div id=wrap><div class='menu'><ul><li>One<li>Two</ul></div><div class=post>{MAIN}</div><div id=comments><p>{LONG}</p></div></div>",
    f"<div role=banner>Top</div><div><div>{MAIN}</div></div><div><a href=x>One</a> <a href=y>Two</a></div>",
    f"<article>{MAIN}<form><label>Mail</label><input><button>Go</button></form></article><article class=comment><p>{LONG}</p></article>",
    f"<form id=page><input type=hidden><main>{MAIN}</main></form>",
    f"<article>{MAIN}<script>var x = '</p><p>no text';</script><style>p {{}}</style><noscript>no</noscript></article>",
    f"<body class='has-sidebar'><article class='post no-comments'>{MAIN}<div class='ad-box'>{LONG}</div></article>",
    f"<article><p>{LONG}<p>Short.<p>{LONG}</article><p class=advert>{LONG}",
    f"<article>{MAIN}</article><div class='newsletter'>{LONG}</div><a href='cut off",
    f"<article>{MAIN}<!-- never closed",
])
def test_regions(page):
    want = " ".join(f"{LONG} Short. {LONG}".split())
    assert html_text.main_text(page)[0] == want


def test_text_of_a_block():
    assert html_text.main_text("<p>a<b>b</b>c&amp;&lt;&nbsp;\n d<br>e</p>")[0] == "abc&< d e"
    assert html_text.main_text("<article><header><h1>Title</h1><span>by me</span></header><p>Text</p></article>")[0] == "Title Text"
    assert html_text.main_text("<![odd[ x]]>ok &#xD800; <3 &unknown;")[0] == "ok � <3 &unknown;"


def test_chunks_do_not_show(monkeypatch):
    page = f"<nav><a href='/x?a=1&amp;b=2'>Home</a></nav><article><h1>T &amp; U</h1>{MAIN}<script>if (a < b) {{}}</script>é</article>" * 2
    want = html_text.page_lines(page)
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(html_text, "CHUNK", size)
        assert [x.text for x in html_text.page_lines(page)] == [x.text for x in want]


def test_smoothing_and_threshold():
    import numpy as np
    flat = html_text.smoothed(np.ones(9), 1.0)
    assert np.allclose(flat, 1.0)
    peak = html_text.smoothed(np.eye(1, 9, 4)[0], 1.0)
    assert peak.argmax() == 4 and np.allclose(peak[:4], peak[:4:-1])
    lines = html_text.page_lines("<p>a</p>" * 5 + f"<p>{LONG}</p>" * 4 + "<p>a</p>" * 5)
    cluster = html_text.content_lines(lines, 1.0, 1.0)
    assert cluster[5:9].all() and not cluster[:3].any() and not cluster[-3:].any()


def test_defined_results(spark):
    odd = spark.createDataFrame(
        [(1, "u", None, "x", 1), (2, None, "", "x", 1), (None, "v", "<p>a", "x", 1), (3, "u", "<p>b</p>", "x", 1), (3, "u", "<p>b</p>", "x", 1),
         (4, "u", "<article>" + "<p>word </p>" * 50_000 + "</article>", "x", 1), (5, "u", "<nav>only</nav>", "x", 1)],
        "page_id long, url string, html string, text string, n_chars int")
    got = html_text.extract_text(odd).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in got) == [
        ("1", 0), ("2", 0), ("3", 1), ("3", 1), ("4", 50_000 * 5 - 1), ("5", 0), ("None", 1)]
    assert html_text.extract_text(odd.limit(0)).count() == 0
    raw = spark.sql("SELECT 1L AS page_id, 'u' AS url, CAST(unhex('3C703E61FF62') AS STRING) AS html")
    assert html_text.extract_text(raw).first()["text"] == "a�b"
