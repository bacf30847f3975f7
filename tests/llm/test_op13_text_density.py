"""Main texts of pages whose article is known, and the densities against their definition."""

import math
import re

import duckdb

from terrace.llm import text_density
from terrace.llm.text_density import composite, main_text, parsed

PARAGRAPHS = [f"Paragraph {i} of the article says this and that about its matter, with <a href='/x'>one link</a> &amp; some more words." for i in range(6)]
CLEAN = [re.sub("<[^>]*>", "", p).replace("&amp;", "&") for p in PARAGRAPHS]
AROUND = """<html><head><title>T</title><style>p{}</style><script>var t="</p><p>not text";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=/>home</a></ul></nav><div class="cookie-notice">We use cookies, and this goes on for a while.</div>
<div id="sidebar"><p>Other things that are read here by many people every day of the week.</p></div><form><label>Mail</label><input></form>
%s
<section class="comments"><div class="comment"><p>I liked this article a lot, it is longer than most of those that I have read here before.</p></div></section>
<div class="adBox"><p>Buy now</p></div><footer>&copy; someone</footer></body></html>"""


def article(paragraphs=PARAGRAPHS):
    return "".join(f"<p>{p}</p>\n" for p in paragraphs)


def test_the_article_and_nothing_around_it():
    for wrap in ("<article><h2>Head</h2>%s</article>", "<main><div><h2>Head</h2>%s</div></main>", "<div class='post-content'><h2>Head</h2>%s</div>", "<article><header><h2>Head</h2></header>%s</article>"):
        assert main_text(AROUND % (wrap % article())) == "\n\n".join(["Head", *CLEAN]), wrap
    assert main_text(AROUND % f"<div><div>{article()}</div></div>") == "\n\n".join(CLEAN)


def test_thresholds_take_a_second_stretch():
    """Without an article element, boxes as dense as the path to the body are text, thin ones aren't."""
    page = f"<body><div>{article()}</div><div><p>thin</p></div><div>{article(PARAGRAPHS[:4])}</div></body>"
    assert main_text(page) == "\n\n".join([*CLEAN, *CLEAN[:4]])


def test_blocks_and_references():
    page = "<article><p>a&nbsp;b<br>c \n d<b>e</b>f<p>g &lt;h&gt; &#233;<ul><li>one<li>two</ul>tail<table><tr><td>x<td>y</table><!-- no --> <pre>k  l\nm</pre></article>"
    assert main_text(page) == "a b c def\n\ng <h> é\n\none\n\ntwo\n\ntail\n\nx\n\ny\n\nk l m"


def test_left_out_end_tags_and_odd_markup():
    assert main_text("<article><h1>Title</h1><p><b>Title<br><p>Second</article><footer>no</footer>") == "Title\n\nTitle\n\nSecond"
    assert main_text("<article><p>a < b and c > d <a title='x>y'>link</a> text of some length</p></article>") == "a < b and c > d link text of some length"
    assert main_text("<article><p>cut <script>never ends <p>x") == "cut"
    assert main_text("<form><article><p>A page that is one form.</p></article><p>not this</p></form>") == "A page that is one form."
    assert main_text("<div>" * 20_000 + "deep text" + "</div>" * 20_000) == "deep text"


def test_pages_without_an_article():
    for page in (None, "", "   ", "<html></html>", "<nav>menu</nav><footer>foot</footer>", "<script>x</script>", "<!-- text -->"):
        assert main_text(page) == ""
    assert main_text("just words") == "just words"


def test_menus_of_links_inside_go():
    links = "".join(f"<li><a href='/{i}'>related thing {i}</a></li>" for i in range(5))
    assert main_text(f"<article>{article()}<ul>{links}</ul></article>") == "\n\n".join(CLEAN)


def test_density_is_its_definition():
    for c, t, lc, lt, r in ((500, 7, 40, 3, 0.2), (1000, 1, 0, 0, 0.0), (30, 4, 29, 2, 0.9)):
        c_, t_, lc_, lt_ = c, max(t, 1), max(lc, 1), max(lt, 1)
        want = c_ / t_ * math.log((c_ / lc_) * (t_ / lt_)) / math.log(math.log(c_ / (c_ - lc_) * lc_ + r * c_ + math.e))
        assert math.isclose(composite(c, t, lc, lt, r), max(want, 0.0))
    assert composite(0, 3, 0, 0, 0.1) == composite(9, 2, 9, 2, 0.1) == 0


def test_tree_of_tags():
    tree = parsed("<ul><li>a<ul><li>b</ul><li>c</ul>")
    assert [(n, tree.names[p]) for n, p in zip(tree.names[1:], tree.parents[1:])] == [("ul", "#page"), ("li", "ul"), ("ul", "li"), ("li", "ul"), ("li", "ul")]


def test_pages_of_the_tables(spark):
    """Every given page has one article element; its blocks are what lies between its block tags."""
    path = "/root/testdata/sf0.001/pages.parquet"
    got = {r.page_id: r.text for r in text_density.extracted(spark.read.parquet(path)).collect()}
    import html

    for i, page in duckdb.sql(f"SELECT page_id, html FROM '{path}'").fetchall():
        blocks = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*)</article>", page, re.S)[1])
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks)
        assert got[i] == "\n\n".join(b for b in blocks if b)


def test_awkward_rows(spark):
    rows = [(1, "u", None, "t", 1), (1, "u", "", "t", 1), (None, None, "<p>" + "word " * 100_000, "t", 1), (2, "u", "<article>x y</article>", "t", 1), (2, "u", "<article>x y</article>", "t", 1)]
    out = text_density.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int"))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.n_chars, len(r.text)) for r in out.collect()) == [(0, 0), (0, 0), (3, 3), (3, 3), (499_999, 499_999)]
    assert text_density.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
