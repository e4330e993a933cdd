import re
from html import unescape

import pytest

from martforge.llm import wrappers as H


def plain(html):
    """The article's blocks, cut out with the generator's own marks."""
    m = re.search(r"<article>(.*?)(?:</article>|\Z)", html or "", re.S)
    if not m:
        return ""
    blocks = re.split(r"</?(?:h1|p)>", m[1])
    blocks = [" ".join(unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


PAGE = ("<!DOCTYPE html><html><head><title>t</title><script>var a='<p>no</p>';</script><style>p{}</style></head><body>"
        "<nav><ul><li><a href='/'>home</a></li><li>about</li></ul></nav><header class=\"site-header\">Site</header><!-- <p>no</p> -->"
        "<div class='cookie-notice'>We use cookies</div><main><article><header><h1>A &amp; B</h1><p>By me</p></header>%s"
        "<form><input name=q><button>Go</button></form></article><section id=comments><h2>Comments</h2><p>first!</p></section></main>"
        "<aside>more</aside><footer>&copy; me</footer></body></html>")


def test_roles():
    pages = [PAGE % "".join(f"<p>text {i} of\n <b>page</b>&nbsp;{n}<br>x<ul><li>one<li>two</ul>" for i in range(n)) for n in (1, 2, 4)]
    wrapper, keep = H.infer(pages)
    for n, p in zip((1, 2, 4), pages):
        text, matched = H.main_text(p, wrapper, keep)
        assert matched
        assert text == "\n\n".join(["A & B"] + [x for i in range(n) for x in (f"text {i} of page {n} x", "one", "two")])
        alone, _ = H.main_text(p, [], [])
        assert alone == text


def test_template_text_without_article():
    pages = [f"<html><body><div class=x><h2>Daily</h2></div><div id=c{i}><p>own words {i}</p><p>more {i}</p></div><div class=z>All rights</div>" for i in range(4)]
    wrapper, keep = H.infer(pages)
    for i, p in enumerate(pages):
        assert H.main_text(p, wrapper, keep) == (f"own words {i}\n\nmore {i}", True)


def test_alignment_makes_groups_and_options():
    a = H.fold(["<ul>", "<li>", "T", "<li>", "T", "</ul>"])
    assert a == ["<ul>", ["+", ["<li>", "T"]], "</ul>"]
    b = H.align(a, H.fold(["<ul>", "<li>", "T", "</ul>", "<p>", "T"]))
    assert b == ["<ul>", ["+", ["<li>", "T"]], "</ul>", ["?", ["<p>"]], ["?", ["T"]]]
    for keys in (["<ul>", "<li>", "T", "</ul>"], ["<ul>"] + ["<li>", "T"] * 5 + ["</ul>", "<p>", "T"]):
        assert H._whole(b, keys) is not None
    assert H._whole(b, ["<ul>", "</ul>"]) is None


@pytest.mark.parametrize("html", ["", "plain", "<", "<p", "<p>a<p", "a < b > c", "<script>x", "<!-- x", "</p></div>x", "<div" * 500, "<b>" * 3000 + "x",
                                  "<p>x" * 20_000, "<div><p>" * 5000])
def test_broken_html(html):
    text, _ = H.main_text(html, *H.infer([html]))
    assert isinstance(text, str)


def test_table(spark):
    rows = [(1, "http://A.com/x", PAGE % "<p>one", 1), (2, "http://a.com/y", PAGE % "<p>two", 1), (2, "http://a.com/y", PAGE % "<p>two", 1),
            (None, None, "<p>free", 1), (4, "odd", None, 1), (5, "http://b.com", "", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in H.extract(pages).collect()}
    assert got == {(1, "http://A.com/x"): ("A & B\n\none", 10), (2, "http://a.com/y"): ("A & B\n\ntwo", 10), (None, None): ("free", 4),
                   (4, "odd"): ("", 0), (5, "http://b.com"): ("", 0)}
    assert H.extract(pages).count() == 6 and H.extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_whole_table(spark, sf):
    from martforge.llm.queries import QUERIES
    d = f"/root/testdata/{sf}"
    got = {r.page_id: r for r in QUERIES["op8_html_wrappers"](spark, d).collect()}
    rows = spark.read.parquet(f"{d}/pages.parquet").collect()
    assert len(got) == len(rows)
    wrong = [r.page_id for r in rows if got[r.page_id].text != plain(r.html) or got[r.page_id].n_chars != len(plain(r.html))]
    print(sf, "matched", sum(r.matched for r in got.values()) / len(rows))
    assert wrong == [] and sum(r.matched for r in got.values()) > 0.9 * len(rows)


def test_copies_do_not_fill_the_sample(spark):
    from pyspark.sql import functions as F

    html = F.concat(F.lit("<html><body><div>Every page says this</div><p>text "), F.col("id"), F.lit("</p></body></html>"))
    pages = spark.range(12).select(F.col("id").alias("page_id"), F.lit("http://a.example/x").alias("url"), html.alias("html"))
    least = pages.orderBy(F.xxhash64("html")).limit(1)
    pages = pages.unionByName(least.crossJoin(spark.range(20)).select("page_id", "url", "html"))
    got = H.extract(pages).collect()
    assert len(got) == 32 and all(r.text == f"text {r.page_id}" for r in got)


PLAIN = ("<html><body class=\"single no-sidebar\"><div><p>The Daily Example</p></div><div><ul>%s</ul></div><div><h1>Title %d</h1>%s</div>"
         "<div><p>All rights with us</p></div></body></html>")


def plain_page(i):
    menu = "".join(f"<li><a href='/{i}{k}'>Topic {i * 7 + k}</a></li>" for k in range(3 + i % 3))
    own = [f"Paragraph {k} of page {i} tells of its own things, and of nothing else." for k in range(1 + i % 4)]
    return PLAIN % (menu, i, "".join(f"<p>{t}" for t in own)), "\n\n".join([f"Title {i}", *own])


def test_wrappers_tell_the_template_where_a_page_alone_can_not(spark):
    rows = [(i, "http://plain.example/p", *plain_page(i)) for i in range(30)]
    rows += [(100 + k, "http://plain.example/p", *plain_page(3)) for k in range(60)]  # copies don't make a slot fixed
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")).collect()}
    assert got == {r[0]: r[3] for r in rows}
    assert all(H.main_text(r[2], [], [])[0] != r[3] for r in rows)


@pytest.mark.parametrize("html, text", [
    ("<body class='single no-sidebar'><article><p>a</p></article><aside>x</aside>", "a"),
    ("<body><main class='has-sidebar'><p>a</p><div class=sidebar>x</div></main>", "a"),
    ("<article><div class='entry-header'><h1>T</h1><p>" + "An intro that says what it is all about. " * 2 + "</p><div>me</div></div><p>b</p></article>",
     "T\n\n" + " ".join(["An intro that says what it is all about."] * 2) + "\n\nb"),
    ("<article><p class='share-price'>The price of a share fell by three in a hundred on Monday.</p><div class='share'>Share</div></article>",
     "The price of a share fell by three in a hundred on Monday."),
    ("<article><section class=comments><p>" + "A reader's long opinion on all of this. " * 5 + "</p></section><p>b</p></article>", "b"),
    ("<body style='display:none'><article><p>a</p><p hidden>x</p></article>", "a"),
])
def test_names_only_settle_the_rest(html, text):
    assert H.main_text(html, [], [])[0] == text
    assert H.main_text(html, *H.infer([html]))[0] == text


def test_long_and_unlike_pages():
    import time
    start = time.time()
    blocks = lambda tag, n: "".join(f"<{tag} class=c{'abcdefghij'[i % 10]}{'xyz'[i % 3]}><p>text {tag} {i}</{tag}>" for i in range(n))
    pages = [f"<body>{blocks('div', 2_000)}</body>", f"<body>{blocks('section', 2_000)}<div>end</div></body>", f"<body>{blocks('div', 20_000)}</body>"]
    wrapper, keep = H.infer(pages)
    for p, n in zip(pages, (2_000, 2_001, 20_000)):
        assert len(H.main_text(p, wrapper, keep)[0].split("\n\n")) == n
    assert time.time() - start < 60


def test_an_unmatched_page_is_aligned():
    wrapper, keep = H.infer([plain_page(i)[0] for i in range(8)])
    html, text = plain_page(5)
    odd = html.replace("<h1>", "<table><tr><td>odd cell</table><h1>")
    got, matched = H.main_text(odd, wrapper, keep)
    assert not matched and got == "odd cell\n\n" + text


def test_common_subsequences():
    import random
    rng = random.Random(8)
    for _ in range(200):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randrange(12))] for _ in range(2))
        got = H._common(a, b)
        assert all(a[i] == b[j] for i, j in got) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    a = [f"k{i}" for i in range(2_000)]
    b = [x for i, x in enumerate(a) if i % 5] + ["z"] * 500
    assert len(H._common(a, b)) == 1_600
