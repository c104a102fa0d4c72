"""Pages whose articles hold more than paragraphs, tags without an end, and very long pages."""

import random
import time

import pytest
from pyspark.sql import functions as F

from olapkit.llm import page_text as pt
from olapkit.llm.queries import QUERIES

MENU = "<nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>"
FOOT = "<aside><p>Related posts and more.</p></aside><footer>Contact us</footer>"
PARTS = {
    "list": ("<ul><li>One full sentence, which stands in a list.</li><li>Another one.</li></ul>", "One full sentence, which stands in a list. Another one."),
    "numbers": ("<ol><li>First<li>Second<li>Third</ol>", "First Second Third"),
    "table": ("<table><caption>Sums</caption><tr><th>Year</th><th>Sum</th></tr><tr><td>1999</td><td>12</td></tr></table>", "Sums Year Sum 1999 12"),
    "terms": ("<dl><dt>Term</dt><dd>What it means.</dd></dl>", "Term What it means."),
    "code": ("<pre>x = 1\n  y = 2</pre>", "x = 1 y = 2"),
    "quote": ("<blockquote>To quote, or not.</blockquote>", "To quote, or not."),
    "picture": ("<figure><img src=a><figcaption>A picture of it</figcaption></figure>", "A picture of it"),
    "nested": ("<div><section><h2>Part</h2><div><ul><li>In it</li></ul></div></section></div>", "Part In it"),
}
START, END = "First paragraph, of some words and more.", "Closing paragraph, with the last words."


@pytest.fixture(scope="module")
def weights(spark):
    return pt.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("outer", ["article", "div class=content", "main", "div"])
@pytest.mark.parametrize("part", PARTS)
def test_parts_of_an_article_are_kept(weights, part, outer):
    markup, text = PARTS[part]
    inner = f"<p>{START}</p>{markup}<p>{END}</p>"
    page = f"<html><body>{MENU}<{outer}><h1>Title of it</h1>{inner}</{outer.split()[0]}>{FOOT}</body></html>"
    assert pt.main_text(page, weights) == f"Title of it {START} {text} {END}"


@pytest.mark.parametrize("tag", ["button", "select", "svg", "object", "noscript", "template", "iframe", "math"])
def test_a_tag_without_end_hides_nothing(weights, tag):
    page = f"<article><p>{START}</p><{tag}>Share<p>Second paragraph, which is there.</p><p>{END}</p></article>"
    got = pt.main_text(page, weights)
    assert got.startswith(START) and got.endswith(f"Second paragraph, which is there. {END}")
    # A later one that has its end is not taken for it.
    if tag in ("button", "select"):
        later = page.replace("</article>", f"<{tag}>Send</{tag}></article>")
        assert END in pt.main_text(later, weights) and "Send" not in pt.main_text(later, weights)


def test_what_has_an_end_is_left_out(weights):
    page = f"<article><p>{START}</p><button>Share <b>it</b></button><svg><text>no</text></svg><script>x</script><p>{END}</p><script>var open"
    assert pt.main_text(page, weights) == f"{START} {END}"


def test_adverts_and_comments_inside_an_article_go(weights):
    page = (
        f"<article><p>{START}</p><div class='ad-banner'><p>Buy it now, it is cheap.</p></div><p>{END}</p>"
        "<section id=comments><ul><li>Nice one, thanks a lot.</li><li>Agreed.</li></ul></section></article>"
    )
    assert pt.main_text(page, weights) == f"{START} {END}"


def test_a_page_of_100_000_blocks_takes_seconds(weights):
    menus = "".join(f"<nav><a>Menu {i}</a></nav><p>Paragraph {i}, with some words in it.</p>" for i in range(50_000))
    start = time.perf_counter()
    text = pt.main_text(f"<body>{menus}</body>", weights)
    assert time.perf_counter() - start < 30
    assert text.count("Paragraph") == 50_000 and "Menu" not in text
    # One path for the whole flow, from one end of a chain to the other.
    n = 3000
    side = pt.content_side([5.0, *[0.0] * n, -9.0], [(i, i + 1, 1.0) for i in range(n + 1)])
    assert side == [True, *[False] * (n + 1)]


def test_random_cuts_are_least():
    import itertools

    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(1, 9)
        odds = [float(rng.randint(-3, 3)) for _ in range(n)]
        edges = [(i - 1, i, float(rng.randint(0, 2))) for i in range(1, n)]
        edges += [(a, b, float(rng.randint(0, 2))) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.3]

        def cost(side):
            own = sum(max(o, 0) if not s else max(-o, 0) for o, s in zip(odds, side, strict=True))
            return own + sum(c for a, b, c in edges if side[a] != side[b])

        best = min(cost(side) for side in itertools.product([False, True], repeat=n))
        assert cost(pt.content_side(odds, edges)) == pytest.approx(best)


def test_the_query_gives_one_row_a_page(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op7_page_text"](spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/pages.parquet").count()
    assert got.filter(F.length("text") != F.col("n_chars")).count() == 0
