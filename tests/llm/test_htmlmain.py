import itertools
import math

import pytest

from tickloom.llm import htmlmain
from tickloom.llm.dom import read


@pytest.fixture(scope="module")
def model():
    return htmlmain.trained()


PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><a href="/">Logo</a><p>The tagline of the site</p></header>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="cookie-notice">We use cookies to make this site work. Please accept them.<button>OK</button></div>
<div class="ad">Buy this thing now, it is cheap. Very cheap indeed.</div>
{open}<h1>A heading &amp; more</h1><p>First   paragraph of the
article, with <b>bold</b> and <a href="/x">a link</a> inside it.<br>After a break.<p>Second paragraph that was not closed before.
<ul><li>An item of the list in the article</li><li>Another item there</li></ul><blockquote>A quoted sentence, as it was said.</blockquote>{close}
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/r">Other story</a></li></ul></aside>
<form class="newsletter"><label>Mail</label><input name="m"><button>Go</button></form>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I liked this article very much, thanks for it.</p></div></section>
<footer><p>Copyright. All rights reserved, whatever they are.</p></footer></body></html>"""
TEXT = "A heading & more First paragraph of the article, with bold and a link inside it. After a break. Second paragraph that was not closed before. An item of the list in the article Another item there A quoted sentence, as it was said."


@pytest.mark.parametrize("opened,closed", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>"), ("<main><article>", "</article></main>"), ('<div id="wrapper"><div class="article-body">', "</div></div>")])
def test_main_text_of_layouts(model, opened, closed):
    assert htmlmain.main_text(PAGE.format(open=opened, close=closed), model) == TEXT


def test_held_out_composed_pages(model):
    c, right, n = htmlmain.Composer(5), 0, 0
    for _ in range(150):
        page = read(c.page())
        want, got = htmlmain.labels_of(page), model.content(page)
        for node, text, _ in page.runs:
            n += len(text)
            right += len(text) * ((got[node] >= 0.5) == (want[node] == htmlmain.CONTENT))
    assert right / n > 0.97


def test_given_pages(model, spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    import html
    import re

    right = 0
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"</?(b|i|a)\b[^>]*>", "", inner))
        right += htmlmain.main_text(r["html"], model) == " ".join(html.unescape(plain).split())
    assert right == len(rows)


def test_marginals_equal_enumeration():
    m = htmlmain.TreeModel()
    m.edge = [[0.3, -1.0, 0.2], [0.5, 1.1, -0.7], [-0.4, 0.0, 0.9]]
    parents = [-1, 0, 0, 1, 1, 2]
    phi = [(1.0, 0.5, 0.2), (0.3, 1.0, 0.9), (0.7, 0.1, 1.0), (1.0, 0.8, 0.3), (0.2, 1.0, 0.6), (0.5, 0.4, 1.0)]
    belief, _, _ = m.marginals(parents, phi)
    total, want = 0.0, [[0.0] * 3 for _ in parents]
    for labels in itertools.product(range(3), repeat=len(parents)):
        p = math.prod(phi[k][s] for k, s in enumerate(labels)) * math.exp(sum(m.edge[labels[parents[k]]][s] for k, s in enumerate(labels) if k))
        total += p
        for k, s in enumerate(labels):
            want[k][s] += p
    for b, w in zip(belief, want, strict=True):
        assert list(b) == pytest.approx([x / total for x in w])


ODD = [None, "", "   ", "plain words without any markup at all", "<p>unclosed <b>bold", "<<<>>><a", "<script>never closed", "<!-- open", "</div></p>", "<p a='", "<div>" * 3000 + "deep text here" + "</div>" * 3000, "&lt;p&gt;&amp;amp; &#x41;&#0;", "<p>" + "word " * 50_000 + "</p>", "\0<p>\0</p>"]


def test_odd_pages(spark, model):
    rows = [(i, f"u{i}", h) for i, h in enumerate(ODD)] + [(None, None, PAGE), (3, "again", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text")
    out = htmlmain.extract(df, model).collect()
    assert len(out) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in out)
    by = {r["url"]: r["text"] for r in out}
    assert by["u0"] == by["u1"] == by["u2"] == ""
    assert htmlmain.extract(df.limit(0), model).count() == 0


def test_references_and_white_space():
    page = read("<p>a&nbsp;&amp;\n  b<br>c<i>d</i>e</p>f<div>g</div>h")
    assert [t for _, t, _ in page.runs] == ["a & b cde", "f", "g", "h"]


@pytest.mark.parametrize("unit", ["<a ", "<script ", "<", "<p a='", '<p a=">" ', "</x>", "<div>", "<!-", "<!--", "<b>'\"", "<script>", "&", "</div ", "<p>", "<x y"])
def test_malformed_pages_take_linear_time(model, unit):
    import time

    page = unit * (1_000_000 // len(unit))
    start = time.process_time()
    read(page)
    assert time.process_time() - start < 12
    read("<div>" * 20_000 + "</nosuch>" * 100_000)
    assert time.process_time() - start < 14


def test_text_of_formulas_and_objects_stays():
    page = read('<p>It is <math><mi>x</mi><mo>=</mo><mn>1</mn></math> <svg class="i"/>here, <object data="a">a fallback</object> and <svg><title>Icon</title><path d="z"/></svg>more.</p><script>no</script><p>End</p>')
    assert [t for _, t, _ in page.runs] == ["It is x=1 here, a fallback and more.", "End"]


def test_quotes_in_tags():
    page = read("<p title=\"a > b\">one</p><p title='it>s'>two</p><p title=\"open>three</p>")
    assert [t for _, t, _ in page.runs] == ["one", "two", "three"]


TWO = [" ".join(f"This is sentence number {i} of the paragraph, with some plain words in it." for i in range(k, k + 3)) for k in (0, 7)]
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>Menu {i}</a></li>" for i in range(5)) + "</ul>"


@pytest.mark.parametrize("depth", [0, 1, 2, 5, 7])
@pytest.mark.parametrize("menu,foot", [("", ""), (MENU, ""), (f"<nav>{MENU}</nav>", "<footer><p>Copyright. All rights reserved here.</p></footer>")])
def test_short_articles_in_bare_layouts(model, depth, menu, foot):
    body = "<h1>A heading</h1>" + "".join(f"<p>{t}</p>" for t in TWO)
    page = f"<html><body>{menu}{'<div>' * depth}{body}{'</div>' * depth}{foot}</body></html>"
    assert htmlmain.main_text(page, model) == " ".join(["A heading", *TWO])
    plain = f"<html><body>{'<div>' * depth}{''.join(f'<p>{t}</p>' for t in TWO)}{'</div>' * depth}</body></html>"
    assert htmlmain.main_text(plain, model) == " ".join(TWO)


def test_ruby_is_inline_and_an_open_drawing_swallows_nothing(model):
    page = f"<article><p>日本<ruby>語<rt>go</rt></ruby>です。 {TWO[0]}</p><svg><path d='x'><p>{TWO[1]}</p><title>No end<p>{TWO[0]}</p></article>"
    assert htmlmain.main_text(page, model).startswith(f"日本語goです。 {TWO[0]} {TWO[1]}")
