from __future__ import annotations

import pytest

from retailmart.llm.html_text import extract_text, lines_of, main_text, shared_lines

FRAME = "<nav><a href='/x'>Home</a></nav><div class=\"ad\">Buy</div>"


def text_of(page: str) -> str:
    return main_text(page)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("<article><h1>A &amp; B</h1><p>one\n two<br>three <b>bo</b>ld</p></article><footer>f</footer>", "A & B one two three bold"),
        (f"<html><body>{FRAME}<article><p><b>left open<p>next</article><div class='comments'>no</div>", "left open next"),
        ("<main><p>x<script>var t='</p>';</script><style>p{}</style><!-- c --> y</p><aside>no</aside></main>", "x y"),
        ("<article>in<div class='cookie-notice'>no</div><form>no</form> &lt;tag&gt; &#233;&nbsp;z</article>", "in <tag> é z"),
        ("<article>a < b</article>", "a < b"),
        ("<div><p>no article here</p></div>", "no article here"),
        ("<article>cut off in the mid", "cut off in the mid"),
        ("<article><p class=x\">odd <a href='u' title=\"a > b\">quotes</a> <i title=\"open>stay</i></article>", "odd quotes stay"),
        ("<article>x</article><section id=comments><article class=comment>reader</article></section>", "x"),
    ],
)
def test_pages(page, want):
    assert text_of(page) == want


def test_what_neighbours_share_goes(spark):
    def page(own):
        return f"<div>Site name</div><div>Menu line</div><div>{own}</div><div>All rights</div>"

    rows = [
        (1, "http://h.example/a/1", page("first text")),
        (2, "http://h.example/a/2", page("second text")),
        (3, "http://h.example/z", "<p>Site name</p><p>third</p>"),
        (4, "http://other.example/a", page("alone")),
        (5, None, None),
        (None, "http://h.example/a/1", ""),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, text int").coalesce(1)
    got = {r["page_id"]: r["text"] for r in extract_text(frame.coalesce(1)).collect()}
    assert got[1] == "first text" and got[2] == "second text"
    assert got[4] == "Site name Menu line alone All rights"
    assert got[5] == "" and got[None] == ""
    assert extract_text(frame.limit(0)).collect() == []


def test_alignment():
    a, b = list("xabcyabz"), list("abcqab")
    own, other = shared_lines(a, b)
    assert "".join(a[i] for i in sorted(own)) == "abcab" == "".join(b[i] for i in sorted(other))
    assert shared_lines([], ["a"]) == (set(), set())


def test_all_pages_of_the_sample(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r for r in extract_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br)>", inner)]
        assert got[r["page_id"]]["text"] == " ".join(x for x in blocks if x)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<body class="has-sidebar sticky-footer"><div id="page" class="with-comments"><p>text</p></div></body>', "text"),
        ('<article class="post has-comments"><p>text</p><section id="discussion">chapter</section></article>', "text chapter"),
        ('<div class="sidebar-left"><div class="ad">Buy</div><article>text</article></div><div class="ad">Buy</div>', "Buy text"),
        ('<article class="promo comment">text</article><div class="comments">no</div>', "text"),
        ('<main class="menu">text</main>', "text"),
        ('<div class="comments">nothing else</div>', "nothing else"),
    ],
)
def test_class_words_never_empty_a_page(page, want):
    assert text_of(page).removeprefix("Buy ") == want.removeprefix("Buy ")


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<article><p>a</p><svg class="icon"/><p>rest</p></article>', "a rest"),
        ("<article><p>a</p><svg><title>t</title></svg><p>rest</p></article>", "a rest"),
        ("<article>a<math/> b<p>c</article>", "a b c"),
        ("<article>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds <object data=u><param name=n>fallback</object></article>", "so x=2 holds fallback"),
        ("<article>a<select><p>b</p><noscript><p>c</p></article>", "a b c"),
        ("<article>a<script>never closed<p>b</article>", "a"),
    ],
)
def test_text_after_open_or_closed_elements_stays(page, want):
    assert text_of(page) == want


@pytest.mark.parametrize("ranges", [1, 7, 60])
def test_neighbours_do_not_depend_on_ranges(spark, ranges):
    rows = []
    for h in range(12):
        for k in range(2):
            rows.append((2 * h + k, f"http://host{h}.example/{k}", f"<div>Site {h}</div><div>text {h} {k}</div>"))
        rows.append((100 + h, f"http://host{h}.example/0a", "<script>no text</script>"))
    rows += [(None, None, f"<p>no url</p><p>text {k}</p>") for k in range(3)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = sorted((str(r["page_id"]), r["text"]) for r in extract_text(frame, ranges=ranges).collect())
    want = [(str(2 * h + k), f"text {h} {k}") for h in range(12) for k in range(2)] + [(str(100 + h), "") for h in range(12)]
    assert got == sorted(want + [("None", f"text {k}") for k in range(3)])


def test_alignment_of_repeated_lines(monkeypatch):
    import random

    draw = random.Random(5)
    for bits in (1 << 26, 4):
        monkeypatch.setattr("retailmart.llm.html_text.TABLE_BITS", bits)
        for _ in range(500):
            a, b = ([draw.choice(x) for _ in range(draw.randint(0, 12))] for x in ("abc", "abcd"))
            best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
            own, other = shared_lines(a, b)
            assert [a[i] for i in sorted(own)] == [b[j] for j in sorted(other)] and len(own) == best[-1][-1]


def test_lines_a_host_repeats_in_articles_go(spark):
    def page(own):
        return f"<article><p>Share this</p><p>{own}</p><p>By the staff</p></article>"

    copy = "an article that stands on the host three times and is much longer than its frame"
    rows = [(k, f"http://h.example/a/{k}", page(f"text number {k} of the host, long enough")) for k in range(5)]
    rows += [(10 + k, f"http://copies.example/{k}", f"<article><p>{copy}</p></article>") for k in range(3)]
    teaser = "<div>Site name</div><div>the page's text stands in a plain element, number {}</div><article>teaser</article>"
    rows += [(20 + k, f"http://plain.example/{k}", teaser.format(k)) for k in range(3)]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == f"text number {k} of the host, long enough" for k in range(5))
    assert all(got[10 + k] == copy for k in range(3))
    assert all(f"the page's text stands in a plain element, number {k}" in got[20 + k] and "Site name" not in got[20 + k] for k in range(3))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<article><p>a</p><p class="ad">Buy<p>b long text<p>c</article>', "a b long text c"),
        ("<article><p hidden>no<div>text</div></article>", "text"),
        ('<article><ul><li>a<li class="ad">Buy<li>b<ul><li>c</ul><li>d</ul>e</article>', "a b c d e"),
        ('<article><dl><dt>a<dd class="ad">no<dt>b<dd>c</dl></article>', "a b c"),
        ('<article><table><tr><td>a<td class="ad">no<td>b<tr class="ad"><td>no<tr><td>c</table>d</article>', "a b c d"),
        ('<article><p class="ad">no<b>no</b><h2>b</h2></article>', "b"),
        ('<article><div class="ad">no<p>no</div>a</article>', "a"),
        ('<article><p class="ad">no<button>x<p>still a button</button></p>a</article>', "a"),
        ('<article><table class="ad"><tr><td><table><tr><td>no</table>no</table>a</article>', "a"),
        ('<article>the article</article><section id="comments"><article><p>reader says hi</p></article></section>', "the article"),
        ('<article>the article<section id="comments"><article><p>reader says hi</p></article></section> ends</article>', "the article ends"),
        ("<article>brief</article><div id=disqus>" + "<article>a reader has much to say</article>" * 9 + "</div>", "brief"),
        ('<div class="sidebar-wrap"><article>the long article of the page, in a wrapper</article></div><article>x</article>', "the long article of the page, in a wrapper"),
    ],
)
def test_left_out_end_tags_and_comments(page, want):
    got = text_of(page)
    assert got.removesuffix(" x") == want


@pytest.mark.parametrize(
    "page",
    ["<div>x</p>" * 100_000, "<p class=a>x" * 80_000, '<div class="ad">' * 60_000 + "x", '<div class="ad"><article>x' * 40_000, "<li class=b>x" * 80_000, "<b class=ad>x" * 80_000, "<" * 1_000_000, "<article>" + "a &amp; b <i>c</i> " * 60_000],
    ids=["div", "p", "ad", "articles", "li", "b", "less", "inline"],
)
def test_long_pages_take_linear_time(page):
    import time

    start = time.process_time()
    lines_of(page)
    assert time.process_time() - start < 15


def test_an_article_keeps_lines_that_a_few_pages_share(spark):
    """Two neighbours that share a line do not make it frame; half of the host does. Without a partner, nothing goes."""
    rows = []
    for k in range(12):
        shared = "<p>a sentence that stands in two neighbours</p>" if k in (4, 5, 6) else ""
        rows.append((k, f"http://h.example/{k:02}", f"<article><p>Share this</p>{shared}<p>text number {k} of the host, long enough to be one</p></article>"))
    rows += [(20 + k, f"http://two.example/{k}", f"<article><p>Both have this</p><p>but not this one, number {k}</p></article>") for k in range(2)]
    rows += [(30, "http://one.example/", "<article><p>Share this</p><p>alone</p></article>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_text(frame).collect()}
    for k in range(12):
        shared = "a sentence that stands in two neighbours " if k in (4, 5, 6) else ""
        assert got[k] == f"{shared}text number {k} of the host, long enough to be one"
    assert got[20] == "Both have this but not this one, number 0"
    assert got[30] == "Share this alone"


def test_given_pages_lose_nothing_to_their_neighbours(spark):
    """On all pages of sf0.01, the differencing takes no line out of an article."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in extract_text(pages).collect()}
    assert got == {r["page_id"]: text_of(r["html"]) for r in pages.collect()}
    assert len(got) > 200


def test_one_scan_and_any_number_of_ranges(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    few, many = (sorted(map(str, extract_text(pages, ranges=n).collect())) for n in (2, 150))
    assert few == many


def test_odd_rows(spark):
    rows = [(1, None, "<p>x</p>", "h", "t"), (1, None, "<p>x</p>", "h", "t"), (None, "not a url", "plain text", None, None), (2, "http://h/", None, "", ""), (3, "http://h/", "x" * 300_000, "", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string, texts string")
    got = sorted(((r["page_id"] or 0, r["text"]) for r in extract_text(frame).collect()))
    assert got == [(0, "plain text"), (1, "x"), (1, "x"), (2, ""), (3, "x" * 300_000)]
