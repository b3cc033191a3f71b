import html
import re
import time
from pathlib import Path

import pytest

from paddock.llm.extract import extract, main_text

STORY = "A first sentence, with commas, and enough words to be a paragraph of its own. And another one, for good measure."
PARTS = {
    "menu": '<div class="menu"><ul><li><a href=x>One, two, three</a><li><a>Two</a></ul></div>',
    "nav": "<nav><p>Walk, this way, or that way, or any other way that there may be, dear reader.</p></nav>",
    "header": '<header><h1>Site</h1><p>The best site, of all sites, in the world, ever, and more of this.</p></header>',
    "sidebar": f'<div id="right-sidebar"><p>{STORY}</p></div>',
    "aside": f"<aside><p>{STORY}</p></aside>",
    "cookie": f'<div class="cookieNotice"><p>{STORY}</p></div>',
    "advert": f'<section class="ad ad-top"><p>{STORY}</p></section>',
    "form": f"<form><label>{STORY}</label><textarea>{STORY}</textarea></form>",
    "script": f"<script>var a = '<p>{STORY}</p>';</script><style>p {{}}</style>",
    "comments": f'<div id="comments"><div class="comment-body"><p>{STORY}</p></div></div>',
    "footer": f"<footer><p>{STORY}</p></footer>",
    "hidden": f'<div style="display: none"><p>{STORY}</p></div>',
}
BODY = f"<h1>Head &amp; tail</h1><p><b>{STORY}<br><p>Two&nbsp;words\n here</p><ul><li>item</ul><p>End.</p>"
WANT = f"Head & tail {STORY} Two words here item End."


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("holder", ['<article>{}</article>', '<div class="content">{}</div>', "<main><div>{}</div></main>", "<div>{}</div>"])
def test_only_the_article_is_kept(part, holder):
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{PARTS[part]}{holder.format(BODY)}{PARTS[part]}</body></html>"
    assert main_text(page) == WANT
    assert main_text(page.replace("</body></html>", "")) == WANT


def test_parts_inside_the_article_go_too():
    assert main_text(f"<article>{BODY[:-4]}" + "".join(PARTS[p] for p in ("menu", "aside", "form", "comments", "advert")) + "</article>") == WANT


@pytest.mark.parametrize("n", [2, 10, 40])
@pytest.mark.parametrize("holder", ["<article>{}</article>", "<main>{}</main>", "<main><article><div>{}</div></article></main>",
                                    "<div class='wrap'>{}</div>"])
def test_parts_beside_a_long_body_stay(n, holder):
    inner = f"<h1>Head</h1><div class=entry-content>{f'<p>{STORY}</p>' * n}</div><pre>x = 1</pre><blockquote>Said so.</blockquote>"
    page = f"<body>{PARTS['menu']}{holder.format(inner)}{PARTS['footer']}</body>"
    assert main_text(page) == " ".join(["Head", *[STORY] * n, "x = 1", "Said so."])


def test_pages_without_article():
    assert main_text(None) == main_text("") == main_text("<nav><a href=x>a</a></nav><footer>c</footer>") == ""
    assert main_text("just text &am") == "just text &am"
    assert main_text("<p>short") == "short"
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    assert main_text("<article><p>a &#x41; &copy b</article>") == "a A © b"


def test_the_given_pages(spark):
    folder = Path("/root/testdata/sf0.01")
    if not folder.exists():
        pytest.skip("test tables are not there")
    rows = extract(spark.read.parquet(f"{folder}/pages.parquet").selectExpr("*", "'old' AS text")).collect()
    assert len(rows) == 250
    for r in rows:
        body = r["html"].split("<article>")[1].split("</article>")[0]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", body))
        assert r["text"] == " ".join(html.unescape(plain).split())


@pytest.mark.parametrize("odd", ["<![foo[bar]]>", "<![CDATA[x]]>", "<!foo>", "<?php x ?>", "<!>", "</>", "<![if IE]>", "<![", "<!--"])
def test_malformed_declarations_are_no_text(odd):
    assert main_text(f"<p>x</p>{odd}").startswith("x")
    assert main_text(f"<article><p>{STORY}</p>{odd}<p>{STORY}</p></article>").startswith(STORY)


@pytest.mark.parametrize("given", ['id="discussion"', 'id="related-work"', 'id="menu"', 'id="widgets"', 'class="header-files"',
                                   'class="notices-of-motion"', 'class="has-sidebar"', 'class="comments-open"'])
def test_sections_of_the_article_stay(given):
    assert main_text(f"<article><p>{STORY}</p><section {given}><p>{STORY}</p></section></article>") == f"{STORY} {STORY}"


@pytest.mark.parametrize("given", ["page-share", "post-related", "article-sidebar", "shareButtons", "related-posts", "cookie-banner", "ad-slot",
                                   "comments-area", "entry-footer", "sidebar left", "main nav-bar"])
def test_adverts_and_the_like_go_whatever_stands_beside_them(given):
    assert main_text(f"<article><p>{STORY}</p><div class='{given}'><p>{STORY}</p></div></article>") == STORY


def test_reader_comments_inside_the_article_go():
    assert main_text(f"<article><p>{STORY}</p><section id=comments><p>{STORY}</p></section></article>") == STORY


@pytest.mark.parametrize("page", ["<div>" * 200_000, "<a " * 350_000, "<div><p>" * 100_000, "<b>" * 200_000 + "<p>x", "<b><div>" * 50_000,
                                  "<td><p></b>" * 80_000, "<article>" * 50_000, "<p>x</b></i></u>" * 50_000, "<section id=a>" * 100_000])
def test_time_grows_with_the_page_only(page):
    start = time.process_time()
    main_text(page + "end")
    assert time.process_time() - start < 12
