"""Main text: structure, odd markup, and runs that a host repeats."""

import time

import pytest

from corpus_engine.llm.page_text import blocks, chosen, host, main_text

ARTICLE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><aside>Side</aside><div class="ad">Buy</div>
<article><header><h1>Head &amp; line</h1></header><p>One  <b>two</b>&nbsp;three<br>four<p>Five<div class="notice">Cookies</div>
<ul><li>six<li>seven</ul><table><tr><td>a<td>b</table><script>var t="</p>";</script><form><input> <button>Go</button></form>
<blockquote>quo&shy;te</blockquote><!-- <p>no</p> --></article>
<section id="comments"><article class="comment"><p>First!</p></article></section><footer>&copy; me</footer></body></html>"""


def text(html):
    return chosen(blocks(html), set())


def test_structure():
    assert text(ARTICLE) == "Head & line\nOne two three four\nFive\nsix\nseven\na\nb\nquo\xadte"


@pytest.mark.parametrize("html, want", [
    ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<p>1 < 2 <3", "1 < 2 <3"), ("<div><nav>x<article>kept</article>", "kept"),
    ("<article>a<footer>f</footer>b", "a\nb"), ("<main>a</main>", "a"), ("<article><p title='>'>a</p>", "a"), ("<p>a</div>b</p>", "a\nb"),
    ("<script>never closed", ""), ("<p hidden>h</p><p>s</p>", "s"), ("<p>&#233;&eacute;&bogus;</p>", "éé&bogus;"), ("<style>x</style ><p>y", "y"),
    ("<article><div class='entry-header'><h2>H</h2></div><div class=page-header>no</div>t</article>", "H\nt"),
    ("<article>a<div id='post-comments'>c</div><p class='cookie-notice'>n</p>b</article>", "a\nb"),
    ("<ARTICLE><P>Up</P></ARTICLE>", "Up"), ("<div role=navigation>n</div><div>t</div>", "t"), ("a<!--", "a"),
])
def test_markup(html, want):
    assert text(html) == want


@pytest.mark.parametrize("html, want", [
    # names are read as a whole, with their neighbours
    ('<div class="layout no-sidebar"><p>text</p></div>', "text"), ('<div class="has-header wide"><p>text</p></div>', "text"),
    ("<article><p>a long text</p><div id='social-history'><p>b</p></div><div class='post-comments-off'><p>c</p></div><div class='promo-code-explainer'>d</div></article>", "a long text\nb\nc\nd"),
    ("<div class='sidebar-left'>s</div><div class='content'><p>text text</p></div><div class='site-footer'>f</div>", "text text"),
    # what holds most of the text is no chrome by a name alone, nor is what is named after links and holds prose
    ('<form id="aspnetForm"><div><p>a whole page</p></div></form>', "a whole page"), ("<p>a page with</p><form><p>a form</p></form>", "a page with"),
    ("<article><p>a</p><section class='menu'><p>The menu of the day is soup and a large plate of fish with rice and peas</p></section></article>",
     "a\nThe menu of the day is soup and a large plate of fish with rice and peas"),
    ("<article><p>text text text</p><div class='social'>Share: <a>X</a> <a>Mastodon</a></div><ul class='menu'><li>One<li>Two</ul></article>", "text text text"),
    ("<article><p>text</p><div class='comments'><p>one comment is longer than all of the text above it</p></div></article>", "text"),
    # hidden, beside the main element, and nothing but what a name calls chrome
    ('<p style="color:red; display: none">x</p><p>y</p>', "y"), ("<main><p>m</p></main><article class='teaser'><p>t</p></article>", "m"),
    ("<article>one</article><article>two</article>", "one\ntwo"), ("<div class='footer'>only this</div>", "only this"), ("<footer>only this</footer>", ""),
    ("<article>one<span class=ad>x</span> two <span>three</span> four</article>", "one\ntwo three four"),
    # broken markup
    ("<p title='a>b'>t</p>", "t"), ("<p title='a<b>c'>t</p>", "t"), ('<p title="never closed>t</p><p>u</p>', "t\nu"), ("<p title='it>t</p>", "t"), ("a <!odd b", "a <!odd b"), ("x</p", "x</p"),
])
def test_names_and_broken_markup(html, want):
    assert text(html) == want


@pytest.mark.parametrize("piece", ["<a title='x' \"", "<i>|</b>", "<!x", "<svg>", "<p><div>", "<div class=menu><article>", "<ul><li>|</li>", "<a <", "<span class=ad>x</span>y", "<form>", "</div>", "&", "<nav><main>"])
def test_time_grows_with_the_page(piece):
    opened, _, closed = piece.partition("|")

    def seconds(n):
        html = opened * n + closed * n
        return min((lambda t: (blocks(html), time.perf_counter() - t)[1])(time.perf_counter()) for _ in range(3))

    n = 100_000 // len(opened)
    assert seconds(4 * n) < 10 * seconds(n) + 0.2
    assert seconds(1_000_000 // len(opened)) < 20


def test_host():
    assert [host(u) for u in ("https://u:p@A.org:80/x", None, "odd", "http://b.com?q")] == ["a.org", "", "", "b.com"]


def run(spark, pages):
    frame = spark.createDataFrame([(*p, "clash", 1) for p in pages], "page_id long, url string, html string, text string, row int")
    return {r.page_id: (r.text, r.n_chars) for r in main_text(frame).collect()}


def test_repeated_runs_go_from_pages_that_mark_nothing(spark):
    menu = "<div>all of our pages begin with this very long line of links</div>"
    page = lambda body: f"<html><body>{menu}<div>{body}</div></body></html>"
    own = ["the first page has a text of its own which nobody else has", "quite another matter is told on the second page of them"]
    pages = [(1, "http://h/1", page(own[0])), (2, "http://h/2", page(own[1])), (3, "http://other/", page(own[0])),
             (4, "http://m/1", page(own[1])), (5, "http://m/2", page(own[1])), (6, "http://h/6", ARTICLE), (7, "http://h/7", None), (8, None, ""),
             (9, "http://n/1", page(own[0])), (10, "http://n/2", page(own[0]) + "<p>more</p>")]
    got = run(spark, pages)
    whole = [f"all of our pages begin with this very long line of links\n{o}" for o in own]
    assert got[1][0] == own[0] and got[2][0] == own[1]
    assert got[3][0] == whole[0]  # alone on its host
    assert got[4][0] == got[5][0] == whole[1]  # equal pages do not make each other's text boilerplate
    assert got[6] == (text(ARTICLE), len(text(ARTICLE))) and got[7] == got[8] == ("", 0)
    assert got[9][0] == whole[0] and got[10][0] == "more"  # all that is repeated goes, unless nothing would stay


def test_empty_and_long(spark):
    assert run(spark, []) == {}
    long_page = "<article>" + "<p>word &amp; word</p>" * 20_000
    assert run(spark, [(1, "http://a/", long_page), (1, "http://a/", long_page)])[1][1] == 12 * 19_999 + 11


def test_only_what_a_share_of_the_pages_repeats_goes(spark):
    own = lambda k: " ".join(f"w{k}x{i}" for i in range(20))
    menu, foot, quote = "all of our pages begin with this very long line of links", "Copyright Example Inc", "a phrase of eight words that two have"
    page = lambda body, more="": f"<html><body><div>{menu}</div><p>{body}</p>{more}<p>{foot}</p></body></html>"
    pages = [(k, f"http://h/{k}", page(own(k))) for k in range(8)]
    pages += [(8, "http://h/8", page(f"before it {quote} stands")), (9, "http://h/9", page(f"{own(9)} {quote}"))]
    pages += [(10, "http://h/10", page(own(10))), (11, "http://h/11", page(own(10), "<p>one more line</p>"))]
    pages += [(12, "http://h/12", f"<div>{menu} {own(12)}</div>"), (12, "http://h/12", f"<div>{menu} {own(12)}</div>")]
    got = {k: t for k, (t, _) in run(spark, pages).items()}
    assert all(got[k] == own(k) for k in (*range(8), 10))
    assert got[8] == f"before it {quote} stands" and got[9] == f"{own(9)} {quote}"  # two of thirteen pages are no boilerplate
    assert got[11] == f"{own(10)}\none more line"
    assert got[12] == own(12)  # covered text goes from a block, the rest stays


def test_what_many_marked_articles_of_a_host_share_goes(spark):
    own = lambda k: "\n".join(" ".join(f"w{k}x{i}y{j}" for i in range(12)) for j in range(3))
    notice = "Please note that all of this site will be closed over the holidays"
    menu = ["Home page", "World news", "Local news", "Sports and games", "About us"]
    page = lambda k, extra="": f"<main><div>{notice}</div>{''.join(f'<div>{m}</div>' for m in menu)}<p>{own(k).replace(chr(10), '<p>')}<p>Summary{extra}</main>"
    got = {k: t for k, (t, _) in run(spark, [(k, f"http://h/{k}", page(k)) for k in range(8)]).items()}
    assert got == {k: f"{own(k)}\nSummary" for k in range(8)}  # a short heading alone is no run
    mirrors = run(spark, [(k, f"http://m/{k}", page(1, f"<p>line {k}")) for k in range(8)])
    few = run(spark, [(k, f"http://f/{k}", page(k)) for k in range(3)])
    assert all(t.startswith(notice) and own(1) in t for t, _ in mirrors.values()) and all(t.startswith(notice) for t, _ in few.values())
