from __future__ import annotations

import html
import re

import pytest

from keelson.llm.html_text import extract_text, main_text

BODY = "<p>The first paragraph of the article says a good deal about its subject.</p><p>A second one adds &amp; explains more.</p>"
WANT = "The first paragraph of the article says a good deal about its subject.\nA second one adds & explains more."


def test_given_pages(spark, small):
    """Title and paragraphs of the article element, read off by a plainer way that fits these pages alone."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    for r in extract_text(spark.read.parquet(f"{small}/pages.parquet")).collect():
        inner = re.sub(r"</?b>|<br>", "", re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1])
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?p>|</?h1>", inner)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize("page", [
    f"<html><body><article>{BODY}</article></body></html>",
    f"<div id=main>{BODY}</div>",
    f"<body><header><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div class='content'>{BODY}</div><footer>About us</footer>",
    f"<body><div><div>{BODY}</div></div><div class='side-bar sidebar'>{BODY}</div><aside>More</aside>",
    f"<body><main>{BODY}</main><section id='comments'><p>What a long and tedious comment by a reader this is, is it not?</p></section>",
    f"<body><div class='cookie-notice'>We use cookies on this page to do many a thing.</div>{BODY}<form><p>Your mail</p><button>Send</button></form>",
    f"<body>{BODY}<div><a href=a>One more story</a> <a href=b>Another story</a> <a href=c>A third</a></div></body>",
    f"<body><style>p {{ margin: 0 }}</style><script>var x = '</p><p>not text</p>';</script><!-- <p>no</p> -->{BODY}",
    f"<body><div hidden>gone</div><div style='display: none'>gone</div><div role=navigation>gone</div>{BODY}",
    f"<article><section>{BODY.split('</p>', 1)[0]}</p></section><section>{BODY.split('</p>', 1)[1]}</section></article><div class=advert>Buy!</div>",
])
def test_boilerplate_goes(page):
    assert main_text(page) == WANT


@pytest.mark.parametrize("page", [
    *(f"<body><nav>Home</nav><div class='{c}'>{BODY}</div><footer>About us</footer></body>" for c in (
        "content with-sidebar", "no-sidebar", "has-banner", "search-results", "social-layout", "post comments-open")),
    f"<body><div class='elementor-widget x'>{BODY.split('</p>', 1)[0]}</p></div><div class='elementor-widget y'>{BODY.split('</p>', 1)[1]}</div></body>",
    f"<form id=aspnetForm action=/><div>{BODY}</div><div class=sidebar>More of this</div></form>",
    f"<div class='page widget'><main>{BODY}</main></div><div class=comments><p>{'A reader says so. ' * 40}</p></div>",
    f"<div>{BODY}</div><div class=comments><p>{'A reader says so. ' * 40}</p></div>",
])
def test_names_do_not_drop_the_article(page):
    assert main_text(page) == WANT


LONG = "".join(f"<p>Part {i} of what stands beside the article goes on and on about other things.</p>" for i in range(40))


@pytest.mark.parametrize("page", [
    *(f"<body><{t}>{BODY}</{t}><div class=sidebar>{LONG}</div></body>" for t in ("div", "article", "main", "section")),
    f"<body><article>{BODY}</article><div class='cookie-notice'>{LONG}</div></body>",
    f"<body><div>{BODY}</div><div id=comments>{LONG}</div></body>",
    f"<body><article>{BODY}</article><ol class=commentlist><li><article>{LONG}</article></ol></body>",
    f"<body><div class='widget'><article>{BODY}</article></div><div class=related>{LONG}</div></body>",
    f"<body><form action=/><main>{BODY}</main><div class=promo>{LONG}</div></form></body>",
    f"<body><article><div class='social-layout'>{BODY}</div></article></body>",
    f"<body><div class='banner page'><h1></h1>{BODY}</div></body>",
])
def test_structure_outweighs_size(page):
    assert main_text(page) == WANT


def test_lists_of_links_in_an_article():
    sources = "<ul><li><a href=a>Source one</a><li><a href=b>Source two</a><li><a href=c>Source three</a></ul>"
    want = f"{WANT}\nSource one\nSource two\nSource three"
    assert main_text(f"<body><article>{BODY}{sources}</article><ul class=menu><li><a href=d>Home</a></ul></body>") == want
    assert main_text(f"<body><div class=content>{BODY}{sources}</div><div>Imprint</div></body>").startswith(want)


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain", "plain"), ("<p>open <b>tags<p>here", "open tags\nhere"), ("a < b &lt; c&nbsp; d", "a < b < c d"),
    ("<p>x</i></p></div>y", "x\ny"), ("<ul><li>one<li>two</ul>", "one\ntwo"), ("<p>cut off <a href='", "cut off <a href='"),
    ("<script>never ends", ""), ("<td>a<td>b", "a\nb"), ("<p>l<br>m</p>", "l m"), ("<!DOCTYPE html><title>t</title>", ""),
])
def test_broken_pages(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    assert len(main_text("<p>word</p>" * 50_000).split("\n")) == 50_000


def test_odd_rows(spark):
    rows = [(1, None, None, 3), (2, "u", "", 4), (2, "u", BODY, 5), (2, "u", BODY, 5), (None, "u", "x", 6)]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, n_chars long, _t string, _found string")
    got = extract_text(pages)
    assert got.columns == ["page_id", "url", "html", "_t", "_found", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got.collect()) == sorted(
        [(1, "", 0), (2, "", 0), (2, WANT, len(WANT)), (2, WANT, len(WANT)), (0, "x", 1)])
    assert extract_text(pages.limit(0)).count() == 0
