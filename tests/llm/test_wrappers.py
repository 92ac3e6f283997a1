"""Main texts of pages that are put together from known parts, and tree matching by brute force."""

import functools
import html
import random
import re

import pytest
from pyspark.sql import types as T

from weathermart.llm import wrappers as w

SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        *(T.StructField(n, T.StringType()) for n in ("host", "tree", "text", "blocks", "template")),
    ]
)


def extract(spark, rows):
    df = spark.createDataFrame([(*r, "h", "t", "x", "b", "z") for r in rows], SCHEMA)
    return {r.page_id: (r.text, r.n_chars) for r in w.extract(df.repartition(3)).collect()}


def main_text(source):
    page = w.read_page(None, source)
    return "\n".join(b["text"] for b in page[-1])


FURNITURE = """<header><a href=/>Home</a></header><nav><ul><li>One<li>Two</ul></nav>
<div class="sidebar-left"><p>Side</p></div><aside>More</aside><div id="cookieNotice">Cookies!</div>
<div class="ad-box">Buy</div><form action="/s"><label>Find</label><input value=x><button>Go</button></form>
<script>document.write("<p>no</p>")</script><style>p{}</style><!-- <p>no</p> --><noscript>none</noscript>"""
AFTER = """<section class="comments"><h2>Comments</h2><article class="comment"><p>First!</p></article></section>
<footer><p>&copy; Us</p></footer>"""


def test_declared_furniture_is_left_out():
    body = f"<body class='has-sidebar no-comments'>{FURNITURE}<article><header><h1>T &amp; U</h1></header><p>a <b>b</b>c&nbsp;\n d<br>e<p>f<div class='newsletter'>Sign</div><ul><li>x<li>y</ul>z</article>{AFTER}"
    assert main_text(body) == "T & U\na bc d e\nf\nx\ny\nz"
    assert main_text(body.replace("article>", "main>").replace("<article class", "<div class")) == "T & U\na bc d e\nf\nx\ny\nz"
    assert main_text(f"<div>{FURNITURE}<div class='text'>only <i>this</i></div>{AFTER}</div>") == "only this"


@pytest.mark.parametrize(
    "source, text",
    [
        (None, ""), ("", ""), ("plain", "plain"), ("a < b &lt; c", "a < b < c"), ("<p>x<p>y", "x\ny"),
        ("<p title='a>b'>x</p>", "x"), ("<p>x<!-- never closed", "x"), ("<script>x", ""), ("<p>a<table><tr><td>1<td>2<tr><td>3</table>", "a\n1\n2\n3"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("</p></div>x</b>", "x"), ("<title>T</title><p>x", "x"), ("<p hidden>x</p><p style='display: none'>y</p>z", "z"),
        ("<p>x</p" , "x"), ("<a", ""), ("&#x41;&#66;&bogus;", "AB&bogus;"), ("<p>　x\x1fy </p>", "x y"),
    ],
)
def test_odd_markup(source, text):
    assert main_text(source) == text


def page(title, body, note, ad="Ad"):
    parts = "".join(f"<p>{b}</p>" for b in body)
    return f"<title>{title}</title><body><div class=x1>{note}</div><div class=x2>{ad}</div><div class=x3><h1>{title}</h1>{parts}</div><div class=x4>end</div>"


def test_constant_nodes_are_the_template_of_a_host(spark):
    rows = [(i, f"https://a.example/{i}", page(f"T{i}", [f"p{i} {k}" for k in range(1 + i % 4)], "Welcome to A", f"ad {i % 2}")) for i in range(40)]
    rows += [(100 + i, f"http://B.example:80/{i}", page(f"T{i}", ["one", "two"], "Welcome to B")) for i in range(2)]
    rows += [(200, None, page("T", ["p"], "note")), (201, "no host", page("T", ["p"], "note")), (202, None, None), (203, "http://a.example", "")]
    # Copies of one article: equal texts on pages of one title say nothing.
    rows += [(300 + i, f"http://c.example/{i}", page("Same", ["all", "alike"], f"n{i}")) for i in range(30)]
    got = extract(spark, rows)
    for i in range(40):
        text = "\n".join([f"T{i}", *(f"p{i} {k}" for k in range(1 + i % 4))])
        assert got[i] == (text, len(text))
    assert got[100][0] == "Welcome to B\nAd\nT0\none\ntwo\nend"
    assert got[200] == got[201] and got[200][0].startswith("note")
    assert got[202] == got[203] == ("", 0)
    assert got[300][0] == "n0\nAd\nSame\nall\nalike\nend"


def test_a_line_that_all_articles_of_a_host_share_stays_with_weak_evidence(spark):
    rows = [(i, "http://h.example/", f"<title>{i}</title><article><h2>Same</h2><p>{i}</p></article>") for i in range(9)]
    assert {t for t, _ in extract(spark, rows).values()} == {f"Same\n{i}" for i in range(9)}
    rows += [(i, "http://h.example/", f"<title>{i}</title><article><h2>Same</h2><p>{i}</p></article>") for i in range(9, 12)]
    assert {t for t, _ in extract(spark, rows).values()} == {str(i) for i in range(12)}


def test_no_pages(spark):
    assert extract(spark, []) == {}


def test_given_pages_have_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in w.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.sub("</?b>", "", re.search("<article>(.*)</article>", r.html, re.S)[1]).replace("<br>", " ")
        blocks = [" ".join(html.unescape(x).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n".join(x for x in blocks if x)


def tree(draw, depth):
    n = draw.randint(0, 4) if depth else 0
    return w._shape(draw.choice("abc"), tuple(tree(draw, depth - 1) for _ in range(n)))


def test_matches_are_as_large_as_any(spark):
    @functools.cache
    def best(a, b):
        @functools.cache
        def pairs(i, j):
            if i == len(a[1]) or j == len(b[1]):
                return 0
            return max(pairs(i + 1, j), pairs(i, j + 1), best(a[1][i], b[1][j]) + pairs(i + 1, j + 1))

        return 1 + pairs(0, 0) if a[0] == b[0] else 0

    draw = random.Random(4)
    for _ in range(300):
        a, b = tree(draw, 3), tree(draw, 3)
        assert w.read_shape(w.write_shape(a)) == a
        goal = w.Matcher().match(a, b)
        used = [g for g in goal if g >= 0]
        assert len(goal) == a[2] and len(used) == best(a, b) and used == sorted(set(used))


def test_long_and_deep_pages():
    many = "".join(f"<h2>{i}</h2><p>x<p>y" for i in range(20_000))
    assert w.read_page(None, many)[1] == "html(h2,p)"
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>out") == "deep\nout"
    mixed = w.read_shape("html(" + ",".join(random.Random(1).choices(["a", "b", "c(d)"], k=3000)) + ")")
    other = w.read_shape("html(" + ",".join(random.Random(2).choices(["a", "b", "c(d)"], k=3000)) + ")")
    assert sum(g >= 0 for g in w.Matcher().match(mixed, other)) > 2000
