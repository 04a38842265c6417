import html
import random
import re
import time
from collections import Counter

import pytest

from tontine.llm import html_extraction as H
from tontine.llm.html_extraction import Page, main_texts

FURNITURE = ("<ul class=x><li>Home<li>About us</ul>", "<div>Buy <b>now</b> for less</div>", "<div><p>Terms and so on</p></div>")


def page(rnd, article, furniture=FURNITURE):
    top, mid, low = furniture
    return (f"<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{top}"
            f"<!-- c -->{mid}{article}{low}{'</body></html>' if rnd.random() < .5 else ''}")


def articles(rnd, n):
    return ["".join(f"<p>{'<b>' if rnd.random() < .3 else ''}w{rnd.randrange(10**6)} &eacute;&nbsp;a&lt;b  \n c{rnd.choice(['', '</p>'])}"
                    for _ in range(rnd.randrange(1, 6))) for _ in range(n)]


def plain(fragment):
    cut = re.sub(r"</?(p|h1|br|div|section)[^>]*>", " ", fragment)
    return " ".join(html.unescape(re.sub(r"<[^>]+>", "", cut)).split())


def test_template_subtrees_go_and_articles_stay(spark):
    rnd = random.Random(1)
    bodies = articles(rnd, 40)
    bodies[3] = bodies[4] = bodies[5] = bodies[6]                      # copies of one article on one site
    rows = [(i, f"http{'s' * (i % 2)}://Site.example/{i}", page(rnd, f"<article><h1>T{i}</h1>{b}</article>")) for i, b in enumerate(bodies)]
    rows += [(100 + i, "http://plain.example/", page(rnd, f"<div id=x>{b}</div>")) for i, b in enumerate(bodies)]
    rows += [(200, "http://lone.example/", page(rnd, "<main><p>alone</p><form>f</form><aside>s</aside></main>")),
             (300, None, None), (301, "", ""), (302, "u", "just text"), (None, "http://lone.example/", "<p>one<p>two"),
             (303, "http://x.example", "<p>" + "long " * 50000), (304, "http://y.example", "<div><b><p>a</div>&amp b&#x41;<br>c<")]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "page_id long, url string, html string, text string, host string, template string")
    got = {r.id: r for r in main_texts(df).collect()}
    assert len(got) == len(rows)
    for i, b in enumerate(bodies):
        assert got[i].text == plain(f"<h1>T{i}</h1>{b}"), i
        assert got[100 + i].text == plain(b), i
    assert got[0].url == "http://Site.example/0"
    assert got[200].text == "alone" and got[300].text == "" and got[301].text == "" and got[302].text == "just text"
    assert got[None].text == "one two" and got[303].text == ("long " * 50000).strip() and got[304].text == "a & bA c<"
    assert main_texts(df.limit(0)).count() == 0


def test_blocks_on_a_few_pages_of_a_large_site_stay(spark):
    """Lists, tables and bare divs of articles on three or more pages, far from half of them."""
    rnd = random.Random(2)
    shared = "<ul><li>Introduction</ul><table><tr><td>Yes<td>No</table><dl><dt>Weight<dd>2 kg</dl><div>Loose words</div>"
    shared += "<table>" + "".join(f"<tr><td>a{j}<td>On" for j in range(9)) + "</table>"        # a cell of many rows
    own = [f"<p>w{i}</p>" for i in range(40)]
    rows = [(i, "http://big.example/", page(rnd, f"<article>{b}{shared if i < 5 else ''}</article>")) for i, b in enumerate(own)]
    rows += [(100 + i, "http://bare.example/", page(rnd, "<div>Only words</div><div>in divs</div>" if i < 3 else f"<div>{b}</div>"))
             for i, b in enumerate(own)]
    cells = " ".join(f"a{j} On" for j in range(9))
    got = {r.id: r.text for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(40):
        assert got[i] == f"w{i}" + (f" Introduction Yes No Weight 2 kg Loose words {cells}" if i < 5 else ""), i
        assert got[100 + i] == ("Only words in divs" if i < 3 else f"w{i}"), i


def test_template_sets_do_not_grow_with_the_pages(spark, monkeypatch):
    """Links beside the article that recur on three pages each."""
    tables = {}
    written = H.materialize
    monkeypatch.setattr(H, "materialize", lambda df, name: tables.setdefault(name, written(df, name=name)))
    rows = [(i, "http://links.example/", f"<div><div>tag{i // 3}</div></div><article><div>Share</div><p>w{i}</p></article>") for i in range(90)]
    got = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r.text for r in got) == sorted(f"w{i}" for i in range(90))
    assert [len(r.template) for r in tables["templates"].collect()] == [1]


def test_self_described_parts_go_on_any_page():
    body = """<header>H</header><nav>N</nav><div class="site-footer">F</div><div role=search>R</div><article><header><h1>Title</h1></header>
    <p>One <a href=#>link</a>ed<sup>1</sup> word</p><div class="ad">A</div><form>Q</form><ul><li>first<li>second</ul>
    <section id="comments"><article class="comment"><p>C</p></article></section><noscript>S</noscript></article><aside>B</aside>"""
    assert Page(body).main_text(set()) == "Title One linked1 word first second"


@pytest.mark.parametrize("holder", ['<body class="home has-sidebar">', '<html class="modal-ready"><body>', '<div class="content no-sidebar">',
                                    '<div class="widget Blog">', '<body id="page-header" class="menu">', '<div id="social"><div class="header">'])
def test_names_of_what_holds_the_article_say_nothing(holder):
    assert Page(f"{holder}<div class=sidebar>S</div><article><h1>T</h1><p>body</p></article>").main_text(set()) == "T body"
    assert Page(f"{holder}<main><p>body</p></main>").main_text(set()) == "body"


def test_names_count_as_a_whole_and_not_on_text():
    body = """<article><header class="entry-header"><h1>Title</h1></header><h2 id="social-policy">Policy</h2><p class="notice-period">Notice</p>
    <table class="ads-by-year"><tr class="related"><td id="share">9</table><p class="ad">Said</p><div class="notice">Mind</div>
    <div class="big Ad">gone</div><section id="comments"><article class="comment">gone</article></section></article>"""
    assert Page(body).main_text(set()) == "Title Policy Notice 9 Said Mind"
    assert Page('<div class="site-footer">F</div><div class="ads-free">kept</div><div class="menu">M</div>').main_text(set()) == "kept"
    assert Page('<div class="widget"><p>all there is</p></div>').main_text(set()) == "all there is"
    assert Page('<section id="comments"><article class="comment">C</article></section><p>P</p>').main_text(set()) == "P"


def test_time_grows_with_the_length():
    """Unclosed elements and closing tags that close nothing."""
    for part, n in (("<b>x</i>", 120_000), ("<p><button><b>x<hr>", 50_000), ("<div><b><article></p>", 40_000), ("<li><ul><i>x</li></dd>", 40_000)):
        started = time.time()
        Page(part * n).main_text(set())
        assert time.time() - started < 30, part


def test_counts_equal_a_slow_recount(spark, monkeypatch):
    """The outermost template subtrees of every host, recounted page by page without Spark."""
    rnd = random.Random(8)
    tables = {}
    written = H.materialize
    monkeypatch.setattr(H, "materialize", lambda df, name: tables.setdefault(name, written(df, name=name)))
    bits = ["<ul><li>Home<li>About</ul>", "<div><div>Deep <b>er</b></div>more</div>", "<p>often</p>", "<div>now and then</div>", "<table><tr><td>1<td>2</table>"]
    rows = []
    for k in range(90):
        some = [b for b in bits if rnd.random() < 0.6] + [f"<div>own {k}</div>", f"<p>w{rnd.randrange(4)}</p>"]
        rnd.shuffle(some)
        middle = "".join(some)
        rows.append((k, f"http://h{k % 3}.example/", f"<article>{middle}</article>" if k % 3 == 0 else f"<body>{middle}"))
    got = {r.id: r.text for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for host in range(3):
        pages = [Page(h) for k, _, h in rows if k % 3 == host]
        found = [p.candidates() for p in pages]
        counts = Counter(key for c in found for key in {key for key, _, _ in c})
        inside = {key for c in found for key, _, i in c if i}
        template = {key for key, n in counts.items() if n >= H.MANY and 2 * n >= len(pages) and key in inside}
        outer = {key for c in found for key, parent, _ in c if key in template and parent not in template}
        spark_side = [set(r.template) for r in tables["templates"].collect() if r.host == f"h{host}.example"]
        assert spark_side == ([outer] if outer else [])
        for (k, _, _), p in zip([r for r in rows if r[0] % 3 == host], pages, strict=True):
            assert got[k] == p.main_text(outer)


def test_blocks_of_the_page_order():
    assert Page("a<div>b<div>c</div>d</div>e<table><tr><td>f<td>g</table>").main_text(set()) == "a b c d e f g"
