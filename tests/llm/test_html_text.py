import time

from changeguard.llm import html_text as H

SCHEMA = "page_id long, url string, html string, text string"
PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var a="</p><article>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav>
<div class="cookie-notice">We use cookies</div>
<div id="main-{n}" class="post-{n}"><h1>Title &amp; more</h1><p>First <b>bold
 text<br>line two &lt;ok&gt;&nbsp;x<p>Second <a href='x>y'>link</a> text &am &amp
<ul><li>one<li>two</ul>
<form><input value="q"><label>Search</label></form>
<section class="comments"><p>A reader says things at length, much longer than the article itself, on and on and on.</p></section>
</div><aside>Side</aside><div class="ad">Buy</div><footer>&copy; Foot</footer>"""
TEXT = "Title & more\nFirst bold text line two <ok> x\nSecond link text &am &\none\ntwo"


def texts(rows, pages):
    return {r.page_id: r["__text"] for r in H.extract(rows([(*p, "clash") for p in pages], SCHEMA)).collect()}


def test_article_without_the_rest(rows):
    out = texts(rows, [(i, f"https://u:p@Host.example:8080/{i}?a", PAGE.format(n=i)) for i in range(5)])
    assert set(out.values()) == {TEXT}


def test_the_host_outvotes_a_page_with_a_long_side_block(rows):
    normal = "<body><div class='story'><p>" + "word " * 30 + "</p></div><div class='more'><p>short</p></div>"
    odd = "<body><div class='story'><p>brief story</p></div><div class='more'><p>" + "teaser " * 200 + "</p></div>"
    out = texts(rows, [(i, "http://h/x", normal) for i in range(6)] + [(9, "http://h/y", odd), (10, "http://other/y", odd)])
    assert out[9] == "brief story"
    assert out[10].startswith("teaser")


def test_null_empty_broken_and_long(rows):
    broken = "<p>a < b <div class=\"x>never closed <article"
    out = texts(rows, [(1, None, None), (2, "http://h", ""), (3, "no host", broken), (4, "", "plain & text"), (5, "http://h", "<p>" + "x " * 60_000)])
    assert out[1] == out[2] == ""
    assert out[4] == "plain & text" and "never closed" in out[3]
    assert len(out[5]) == 119_999
    assert H.extract(rows([], SCHEMA)).count() == 0


def test_hosts_are_read_alike_in_both_places(spark, rows):
    from pyspark.sql import functions as F

    urls = ["http://A.b/c", "a.b?x=http://z", "https://u:p@a:1/#", "//x/y", "", "ftp://[x]/", "a@b@c.d:80"]
    df = rows([(u,) for u in urls], "u string").select("u", F.lower(F.regexp_extract("u", H.HOST, 1)).alias("h"))
    assert {r.u: r.h for r in df.collect()} == {u: H.host_of(u) for u in urls}


def test_numbers_in_classes_are_general():
    a, b = (H.parse(f"<body><div class='post-{n} wide'><p>x") for n in (1, 22))
    assert a.containers[1].path == b.containers[1].path == "body/div.post-#.wide"


def test_hostile_pages_end():
    """Unclosed tags and quotes, deep nesting and endless comments of a megabyte take seconds."""
    began = time.monotonic()
    for html in ("<b " * 350_000, "<b \"" * 250_000, "<b '" * 250_000 + ">", "<!" * 500_000, "<!--" * 250_000, "</b>" * 250_000):
        H.page_text(html, None)
    deep = H.parse("<div>" * 100_000 + "in the middle" + "</div>" * 50_000 + "<p>after</b>")
    assert deep.inside({0}) == "in the middle\nafter" and len(deep.containers) == 100_001
    assert max(len(c.path) for c in deep.containers) < 400
    each = H.parse("<div>some words" * 20_000)
    assert each.containers[0].text == 20_000 * len("some words") and each.containers[1].text == each.containers[0].text
    assert time.monotonic() - began < 30


def test_what_never_ends_hides_the_rest():
    assert H.page_text("<p>one</p><!-- two <p>three</p> four", None) == "one"
    assert H.page_text("<p>one</p><script>two</p> three", None) == "one"
    assert H.page_text("<p>one</p> two <!-- three", None) == "one\ntwo"
    assert H.page_text("<p>one <b two", None) == "one <b two"
    assert H.page_text("<p>one</p><!-- x -->two", None) == "one\ntwo"


def test_an_article_may_be_named_as_it_likes():
    assert H.page_text('<body><article class="social-science widget"><p>Long text here.</p></article></body>', None) == "Long text here."
    page = '<body><article><p>Long text here.</p></article><article class="comment"><p>Nice!</p></article><div class="share">x</div></body>'
    assert H.page_text(page, None) == "Long text here."
