"""Main text of pages: single pages, templates per host against plain counting, odd input."""

import re
from collections import defaultdict
from html import unescape

import pytest

from tests.conftest import values
from tripmart.llm.html_text import main_text
from tripmart.llm.html_tree import read_page

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, text string, row int, host string"


def text_of(html):
    return "\n".join(t for t, _ in read_page(html)[1])


@pytest.mark.parametrize("html, want", [
    ("", ""),
    ("just &amp; words &eacute;&#x20AC;", "just & words é€"),
    ("<p>a <b>b</b>\n\n c<p>d<br>e</p>", "a b c\nd e"),
    ("<article><h1>T</h1><p>x<script>var t='</p>'</script>y</p></article><div>out</div>", "T\nxy"),
    ("<nav><ul><li>m</li></ul></nav><header>h</header><main><header><h1>T</h1></header><p>x</p></main><footer>f</footer>", "T\nx"),
    ("<body><div class='side-bar sidebar'>s</div><div id=content><p>x</p></div><form>q</form><!-- c --></body>", "x"),
    ("<div class='layout has-sidebar'><article><h1>T</h1><p>x</p><div class=ad>buy</div><section id=comments><p>first!</p></section></article></div>", "T\nx"),
    ("<div class='page sidebar-left'><article><h1>T</h1><p>x</p></article><div class=sidebar>s</div></div>", "T\nx"),
    ("<article><p>x</p></article><section class=comments><article class=comment><h1>no</h1><p>c</p></article></section>", "x"),
    ("<div class=cookie-notice>c</div><table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<p>one<div>two</div>three", "one\ntwo\nthree"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", "a\nb\nc"),
    ("<p>never closed <i>x", "never closed x"),
    ("<p>a < b & c &lt;p&gt; &nbsp;z</p>", "a < b & c <p> z"),
    ("<div hidden>no</div><p style='display: none'>no</p><p>yes <span class=share>no</span>end</p>", "yes end"),
    ("<script>only", ""), ("<style>p{}</style>", ""), ("</div></p></b>x", "x"),
])
def test_one_page(html, want):
    assert text_of(html) == want


def test_given_pages_give_their_articles(spark):
    """Plain reading of the test pages: what stands between the article tags, block by block."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for page_id, html in values(pages, "page_id", "html"):
        body = re.search(r"<article>(.*?)(</article>|$)", html, re.S).group(1)
        blocks = re.split(r"</?(?:p|h1|footer)>", body)
        plain = [" ".join(unescape(re.sub(r"<[^<>]*>", "", re.sub(r"</?b>", "", b))).split()) for b in blocks]
        want[page_id] = "\n".join(p for p in plain if p)
    got = dict(values(main_text(pages), "page_id", "text"))
    assert got == want


def site(n, host="a.org", box="<div class=x1>Best of our site, since 1999. Visit {n} offers</div>"):
    """Pages whose template has no telling class; one prose line on all pages, one box on two."""
    made = []
    for i in range(n):
        extra = "<div class=z>only twice</div>" if i < 2 else ""
        made.append((
            i, f"http://{host}/p/{i}",
            f"<html><body>{box.format(n=i)}<div class=x2><p>story {chr(97 + i % 26)} {'x' * i}</p></div>{extra}<div>End <b>mark</b></div></body></html>",
            "t", 1, "h",
        ))
    return made


def test_templates_go_per_host(make):
    made = site(40) + site(3, "small.org")
    got = values(main_text(make(made, SCHEMA).repartition(4)), "url", "text")
    by_host = defaultdict(list)
    for url, text in got:
        by_host[url.split("/")[2]].append(text)
    # Headings are equal (none) on all pages: one heading, so nothing counts as recurring.
    assert all("Best of" in t for t in by_host["a.org"])
    titled = [(i, u, h.replace("<body>", f"<head><title>T {chr(97 + i % 26)}{i // 26}</title></head><body>"), *rest) for i, u, h, *rest in made]
    got = {u: (t, n) for u, t, n in values(main_text(make(titled, SCHEMA).repartition(4)), "url", "text", "n_removed")}
    for i, url, *_ in titled[:40]:
        story = f"story {chr(97 + i % 26)} {'x' * i}".strip()
        assert got[url] == (story + ("\nonly twice" if i < 2 else ""), 2)
    for i, url, *_ in titled[40:]:  # too few pages to tell
        assert got[url][0].startswith("Best of our site, since 1999. Visit") and got[url][1] == 0


def test_copies_of_an_article_stay(make):
    page = "<html><head><title>same</title></head><body><div><p>copied story</p></div></body></html>"
    made = [(i, f"http://a.org/{i}", page, "t", 1, "h") for i in range(50)]
    assert set(values(main_text(make(made, SCHEMA)), "text")) == {("copied story",)}


def test_shared_paragraphs_of_articles_stay(make):
    page = "<article><h1>T{0}</h1><p>very common line</p><p>own {0}</p></article>"
    made = [(i, f"http://a.org/{i}", page.format("abcdefghij"[i % 10] * (i + 1)), "t", 1, "h") for i in range(30)]
    assert all("very common line" in t for (t,) in values(main_text(make(made, SCHEMA)), "text"))


def test_nulls_repeats_long_and_empty(make):
    long = "<article>" + "<p>word word</p>" * 60_000 + "</article>"
    made = [
        (None, None, None, "t", 1, "h"), (1, None, "", "t", 1, "h"), (1, "not an address", "<p>x", "t", 1, "h"),
        (1, "not an address", "<p>x", "t", 1, "h"), (2, "http://b.org", long, "t", 1, "h"),
        (3, "http://b.org", "<div>" * 3000 + "deep", "t", 1, "h"), (4, "http://b.org", "&#xD800;&#0;x", "t", 1, "h"),
    ]
    found = main_text(make(made, SCHEMA))
    assert found.columns == ["page_id", "url", "text", "n_removed"]
    got = values(found, "page_id", "text")
    assert got.count((1, "x")) == 2 and (None, "") in got and (1, "") in got and (3, "deep") in got
    assert dict(got)[2] == "\n".join(["word word"] * 60_000)
    assert len(got) == 7
    assert values(main_text(make([], SCHEMA))) == []
