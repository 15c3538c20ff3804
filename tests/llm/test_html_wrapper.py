import re
from html import unescape

import pytest
from cases import SF_TINY

from reclaim.llm import html_wrapper as hw

PAGES = "page_id long, url string, html string"


def texts(spark, rows, schema=PAGES, **kw):
    return {r.page_id: r.text for r in hw.extract(spark.createDataFrame(rows, schema), **kw).collect()}


def page(i, body, tail="</body></html>"):
    return (f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{x}}</style><script>if (a<b) w('</p>');</script></head><body>"
            f"<nav><ul><li><a href=/a>Menu{i}</a><li><a href=/b>More</a></ul></nav><div class='ad'>Buy {i}</div>{body}<footer>Foot {i}</footer>{tail}")


def test_article_without_boilerplate(spark):
    rows = [(i, f"https://h.example/{i}", page(i, f"<article><h1>Head {i}</h1><p>One &amp; <b>two</b>{i}.<br>Three <p>Four\n  five</p>"
             "<form><input>Send</form><aside>Side</aside><div class=\"comments\"><p>Nice post</p></div></article>")) for i in range(5)]
    assert texts(spark, rows) == {i: f"Head {i} One & two{i}. Three Four five" for i in range(5)}


def test_main_region_without_article_element(spark):
    rows = [(i, "http://x.org", page(i, "<div id=wrap><div class=sidebar>Links links links</div><div class=text>" + f"<p>Story {i} goes on for long, {'word ' * 30}</p>" * 3 + "</div></div>")) for i in range(4)]
    got = texts(spark, rows)
    assert all(got[i] == " ".join([f"Story {i} goes on for long, {'word ' * 30}".strip()] * 3) for i in range(4))


@pytest.mark.parametrize("mark", ['class="box ad"', 'class="col-4 sidebar"', "class='block wide\tcomments'", 'id=x class="a b share-bar"'])
def test_noise_words_after_the_first(spark, mark):
    rows = [(i, "http://n.o", page(i, f"<article><p>Text {i}</p><section {mark}><p>Noise {i}</p></section></article>")) for i in range(3)]
    assert texts(spark, rows) == {i: f"Text {i}" for i in range(3)}


STORY = "Story {i} goes on, " + "word {i} " * 30


@pytest.mark.parametrize("start, end", [
    ('<article class="legal">', "</article>"), ('<main class="has-comments">', "</main>"), ('<div role=main class=search>', "</div>"),
    ('<div class="no-sidebar"><article>', "</article></div>"), ('<form method=post><input type=hidden>', "</form>"),
    ('<div id="header-and-content"><div class=text>', "</div></div>"), ('<form><div class="page no-sidebar"><div class=x>', "</div></div></form>"),
])
@pytest.mark.parametrize("n", [1, 4])
def test_main_text_in_elements_with_noise_words(spark, start, end, n):
    rows = [(i, "http://k.l", page(i, f"{start}<h1>Head {i}</h1><p>{STORY.format(i=i)}</p><div class=comments>Nice {i}</div>{end}").replace("<body>", '<body class="no-sidebar">')) for i in range(n)]
    assert texts(spark, rows) == {i: f"Head {i} {STORY.format(i=i).strip()}" for i in range(n)}


def test_long_comments_are_not_the_article(spark):
    rows = [(i, "http://k.l", page(i, f"<div class=text><p>{STORY.format(i=i)}</p></div><div class=comments><p>{STORY.format(i=i) * 4}</p></div>")) for i in range(4)]
    assert texts(spark, rows) == {i: STORY.format(i=i).strip() for i in range(4)}


@pytest.mark.parametrize("start, end", [('<div class="user comments">', "</div>"), ("<form>", "</form>")])
def test_cleared_elements_do_not_displace_text_beside_them(spark, start, end):
    rows = [(i, "http://k.l", page(i, f"<div class=text><p>Short {i}</p></div>{start}<p>{STORY.format(i=i) * 9}</p>{end}")) for i in range(4)]
    assert all(t.startswith(f"Short {i} Story {i}") for i, t in texts(spark, rows).items())


@pytest.mark.parametrize("mark", ['class="related-work"', 'id="search-algorithms"', 'class="share-of-votes"'])
def test_names_with_other_words_are_no_noise(spark, mark):
    rows = [(i, "http://n.o", page(i, f"<article><h1>Head {i}</h1><section {mark}><p>Text {i}</p></section></article>")) for i in range(4)]
    assert texts(spark, rows) == {i: f"Head {i} Text {i}" for i in range(4)}


@pytest.mark.parametrize("mark", ['class="comments-list"', 'id="ad-slot-3"', 'class="newsletter-signup box"', 'class="x related-posts"'])
def test_names_of_noise_and_place_words_are(spark, mark):
    rows = [(i, "http://n.o", page(i, f"<article><p>Text {i}</p><div {mark}><p>Noise {i}</p></div></article>")) for i in range(4)]
    assert texts(spark, rows) == {i: f"Text {i}" for i in range(4)}


def test_text_that_all_pages_share_goes(spark):
    """A marked element with one text on all pages is the template's; a bare
    heading is not, nor is anything where nothing varies."""
    body = '<article><header><h1>Head {0}</h1></header><h2>Summary</h2><p>Text {0}</p><div class="x1">Read our letter now</div></article>'
    rows = [(i, "http://n.o", page(i, body.format(i))) for i in range(4)]
    assert texts(spark, rows) == {i: f"Summary Text {i}" for i in range(4)}
    same = [(i, "http://p.q", page(i, '<article><div class="story"><p>One text</p></div></article>')) for i in range(4)]
    assert set(texts(spark, same).values()) == {"One text"}


def test_deep_pages(spark):
    deep = lambda i: "<div>" * 5000 + f"<p>Deep {i}</p><nav>gone</nav>" + "</div>" * 2500 + f"<p>less {i}</p>" + "</div>" * 2500 + f"<p>Flat {i}</p>"
    rows = [(i, "http://d.e", f"<html><body><article>{deep(i)}</article></body></html>") for i in range(3)]
    assert texts(spark, rows) == {i: f"Deep {i} less {i} Flat {i}" for i in range(3)}


def test_wide_pages_take_linear_time(spark):
    import time

    wide = lambda i, n: "".join(f"<p id=p{i}x{k}>Text {k}</p><b class=c{k % 7}>{i}</b>" for k in range(n))
    rows = [(i, "http://w.i", f"<html><body><article>{wide(i, 20_000)}</article></body></html>") for i in range(3)]
    begun = time.time()
    got = texts(spark, rows)
    assert all(got[i].startswith(f"Text 0 {i} Text 1 {i}") and got[i].count("Text") == 20_000 for i in range(3))
    assert time.time() - begun < 60


def test_common_subsequences():
    import random

    rng = random.Random(3)
    for _ in range(400):
        x, y = ([rng.choice("abcdefghij") for _ in range(rng.randrange(12))] for _ in range(2))
        found = hw.common(x, y)
        assert all(x[i] == y[j] for i, j in found)
        assert all(a < c and b < d for (a, b), (c, d) in zip(found, found[1:]))
    assert len(hw.common(list("abcxdef"), list("abcyydef"))) == 6
    assert hw.common(list("xaybzc"), list("paqbrc")) == [(1, 1), (3, 3), (5, 5)]


def test_odd_pages(spark):
    rows = [
        (1, None, None), (2, "", ""), (3, "no url", "plain <b>text"), (4, "http://a.b/x", "<article>Lone"), (5, "HTTP://A.B:80/y", "<article>&lt;x&gt; &am &amp A&nbsp;B</article>"),
        (6, "http://a.b/", "<article><p>" + "long " * 50_000 + "</article>"), (6, "http://a.b/", "<article>again</article>"), (None, "http://c.d", "<main>m</main>"),
        (8, "http://a.b", "<article><!-- gone --><![CDATA[<raw>]]> 1 < 2 </article>"), (9, "http://a.b", "<article><script>x</article>"),
    ]
    out = hw.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert len(out) == len(rows)
    got = {}
    for r in out:
        got.setdefault(r.page_id, set()).add(r.text)
    assert got[1] == got[2] == {""} and got[4] == {"Lone"} and got[None] == {"m"}
    assert got[5] == {"<x> &am & A B"}
    assert got[6] == {("long " * 50_000).strip(), "again"}
    assert got[8] == {"<raw> 1 < 2"} and got[9] == {""}
    assert all(r.n_chars == len(r.text) for r in out)
    assert hw.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_clashing_columns(spark):
    rows = [(1, "http://a.b", "<article>x</article>", "h", 4, "t")]
    assert texts(spark, rows, PAGES + ", host string, salt int, text string") == {1: "x"}


def test_wrapper_is_union_free_and_generalises():
    pages = [hw.parse(f"<ul><li>a{i}" + "<li>b" * i + f"</ul><h2>Same</h2>{'<p>opt</p>' if i else ''}<i>{i}</i>") for i in range(3)]
    wrapper = hw.infer(pages)
    text = wrapper.expression()
    assert "(<li>#PCDATA)+" in text and "(<p>opt)?" in text and "<h2>Same" in text and "<i>#PCDATA" in text and "|" not in text


def test_every_page_of_a_shape_takes_part():
    pages = [hw.parse(f"<div id=a><p>Story {max(0, i - 2)}</div><div id=b><p>Same</div>") for i in range(6)]
    wrapper = hw.infer(pages)
    assert "<p>#PCDATA" in wrapper.expression() and "<p>Same" in wrapper.expression()
    assert wrapper.size == 6 * len("Story 0Same") and hw.region(wrapper) == ("div id=a",)


@pytest.mark.parametrize("group", [64, 3])
def test_real_pages_equal_a_direct_reading(spark, group):
    rows = spark.read.parquet(f"{SF_TINY}/pages.parquet")

    def plain(html):
        body = html[html.index("<article>") + 9 :]
        body = body[: body.index("</article>")]
        return " ".join(unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body))).split())

    got = {r.page_id: r.text for r in hw.extract(rows, group).collect()}
    assert got == {r.page_id: plain(r.html) for r in rows.collect()}
    w = hw.wrappers(rows, group).collect()
    assert sum(r.n_pages for r in w) == rows.count() and {r.region for r in w} == {"html > body > article"}
