"""Main text of pages."""

import html
import re

import numpy as np
from pyspark.sql import functions as F

from soundlake.llm.html import content, extract, main_text
from soundlake.llm.queries.html import QUERIES

SF = "/root/testdata/sf0.001"


def plain(page):
    body = re.search("<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body)]
    return "\n".join(b for b in blocks if b)


def test_query_against_the_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op3_html_extraction"](spark, SF).collect()
    assert {r.page_id: r.text for r in rows} == {k: plain(h) for k, h in pages.items()}
    assert all(r.n_chars == len(r.text) for r in rows)


LONG = "This is a sentence of the article that goes on for a while, with commas and so on. " * 3
PAGE = f"""<!doctype html><html><head><title>T</title><style>p {{}}</style><script>if (a < b) document.write("<p>no</p>")</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/a>About us and more</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. {LONG}</p></div>
<main><article id=post class="post related"><header><h1>Head &amp; line</h1></header><p>{LONG}<p>Short.<ul><li>one<li>two &lt;b&gt; <b>bold</b>face</ul>
<div class="ad"><p>Buy! {LONG}</p></div><form><label>Your mail</label><input><button>Go</button></form>
<table><tr><td>c1<td>c2</table><blockquote>Said&nbsp;she.<br>Twice.</blockquote><!-- <p>hidden</p> --><p hidden>gone</p><p>{LONG}</p>
<section class="comments"><p>First! {LONG}</p></section></article></main>
<aside><p>Side {LONG}</p></aside><footer>&copy; all</footer></body></html>"""


def test_article_without_its_surroundings():
    long = LONG.strip()
    assert main_text(PAGE).split("\n") == ["Head & line", long, "Short.", "one", "two <b> boldface", "c1", "c2", "Said she. Twice.", long]


def test_pages_without_article_element():
    page = f"<body><div id=top><a href=1>a</a> <a href=2>b</a></div><div><div><p>{LONG}</p><p>Hm.</p><p>{LONG}</p></div></div><div><a href=3>x</a><a href=4>y</a></div></body>"
    assert main_text(page).split("\n") == [LONG.strip(), "Hm.", LONG.strip()]


def test_content_chooses_the_regions():
    long = LONG.strip()
    several = f"<body><article><p>{LONG}</p><p>{LONG}</p><p>a</p></article><article><p>{LONG}</p><p>{LONG}</p><p>b</p></article></body>"
    assert main_text(several).split("\n") == [long, long, "a", long, long, "b"]
    teasers = f"<body><div><p>{LONG * 3}</p><p>Hm.</p></div><article><a href=1>Teaser</a></article><article><a href=2>Next</a></article></body>"
    assert main_text(teasers).split("\n") == [(LONG * 3).strip(), "Hm."]


def test_wrappers_with_telling_names_keep_their_article():
    body = f"<article><h1>Head</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></article>"
    want = ["Head", LONG.strip(), "Short.", LONG.strip()]
    notes = f'<div class="cookie-notice"><p>We use cookies. {LONG}</p></div><div class="comments"><p>First! {LONG}</p><p>{LONG}</p></div>'
    for wrapper in ('div class="page no-sidebar"', 'div id="site" class="has-header sticky"', 'section class="search-open"', 'div class="related-content-layout"', 'form id="aspnetForm"', 'span class="social"'):
        for inner in (body, f'<div class="header-widget">{body}</div>'):
            assert main_text(f"<body><{wrapper}><nav><a href=1>x</a></nav>{inner}{notes}</{wrapper.split()[0]}></body>").split("\n") == want, wrapper
    assert main_text(f'<body><div class="has-sidebar"><div><p>{LONG}</p><p>Hm.</p><p>{LONG}</p></div></div></body>').split("\n") == [LONG.strip(), "Hm.", LONG.strip()]
    assert main_text(f'<body><article><p>{LONG}</p></article><div class="comments"><p>{LONG * 5}</p></div></body>') == LONG.strip()
    assert main_text(f'<body><article><p>{LONG}</p><form><label>Mail</label></form></article></body>') == LONG.strip()


def test_menus_without_a_name_go_and_single_links_stay():
    menu = "<ul><li><a href=/>Home</a></li><li><a href=/a>About</a></li><li><a href=/c>Contact</a></li></ul>"
    page = f"<body><article>{menu}<h1>Head</h1><p>{LONG}</p><p><a href=1>Source</a></p><p>see <a href=2>there</a></p><p>{LONG}</p></article></body>"
    assert main_text(page).split("\n") == ["Head", LONG.strip(), "Source", "see there", LONG.strip()]


def test_the_clustering_decides(monkeypatch):
    """With other content lines other regions are taken, wrappers are seen otherwise, and menus stay."""
    from soundlake.llm import html as module

    pages = [
        f"<body><div><p>a</p><p>b</p><p>c</p></div><div><p>{LONG}</p><p>Hm.</p><p>{LONG}</p></div><div><p>d</p><p>e</p></div></body>",
        f"<body><article><ul><li><a>Home</a></li><li><a>About</a></li><li><a>More</a></li></ul><p>{LONG}</p><p>{LONG}</p></article></body>",
        f"<body><article><a href=1>Teaser</a></article><div><p>{LONG}</p><p>{LONG}</p></div></body>",
    ]
    before = [main_text(p) for p in pages]
    monkeypatch.setattr(module, "content", lambda lines: np.ones(len(lines), bool))
    assert main_text(pages[1]) != before[1]
    monkeypatch.setattr(module, "content", lambda lines: np.arange(len(lines)) == 0)
    assert all(main_text(p) != b for p, b in zip(pages, before))


def test_broken_pages():
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == main_text("<script>never closed") == ""
    assert main_text("just text &eacute; &#x41; &nosuch; a < b") == "just text é A &nosuch; a < b"
    assert main_text("<![bad[ <p>text</p>").endswith("text")
    assert main_text("<article><p>unclosed <i>one<p>two") == "unclosed one\ntwo"
    assert main_text("<div>" * 3000 + "deep") == "deep"
    assert main_text("<p>one</p><![odd[ two <!odd three").startswith("one\n")


def test_threshold_separates_two_clusters():
    lines = [("m", 2, 0)] * 6 + [("x" * 300, 2, 0)] * 8 + [("m", 2, 0)] * 6
    use = content(lines)
    assert use[7:13].all() and not use[:5].any() and not use[-5:].any()


def test_messy_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>" + "a " * 200_000), (2, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("old"), "n_chars": F.lit("old")})
    clash = spark.createDataFrame([(1, "x", 5, "<p>t</p>")], "page_id long, Text string, N_CHARS int, html string")
    assert [tuple(r) for r in extract(clash).collect()] == [(1, "t", 1)]
    got = extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.n_chars for r in got.collect()) == [0, 0, 0, 399_999]
    assert extract(pages.limit(0)).count() == 0
