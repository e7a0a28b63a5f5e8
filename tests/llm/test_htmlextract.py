import html as entities
import re
import time

import numpy as np
import pytest

from jobgrain.llm import htmlextract as h, queries
from jobgrain.llm.boosting import Boosted
from tests.llm.helpers import SF


@pytest.fixture(scope="module")
def sources(spark):
    return [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect()]


@pytest.fixture(scope="module")
def trees(sources):
    return h.fit(sources)


def article(source):
    inner = re.search(r"<article>(.*)</article>", source, re.S)[1]
    parts = [entities.unescape(re.sub(r"<[^>]*>", " ", p)) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(" ".join(p.split()) for p in parts if p.split())


def test_query_gives_the_articles(spark, sources):
    rows = queries.op9_html_extract(spark, SF).collect()
    assert sorted(r.text for r in rows) == sorted(map(article, sources))
    assert all(r.n_chars == len(r.text) for r in rows)


def test_composed_pages(sources, trees):
    paragraphs = [text for s in sources for _, text, links in h.Page(s).leaves if len(text) > 80 and not links]
    composer, same, leaves, right = h._Composer(paragraphs, 1234), 0, 0, 0
    pages = [composer.page() for _ in range(200)]
    for source, got in zip(pages, h.extract(pages, trees)):
        page = h.Page(source)
        want = [text for k, text, _ in page.leaves if page.marked[k]]
        same += got == "\n".join(want)
        kept = set(got.split("\n"))
        leaves += len(page.leaves)
        right += sum((text in kept) == page.marked[k] for k, text, _ in page.leaves)
    assert same >= 170 and right / leaves >= 0.97


def test_parts_that_are_not_main_text(trees):
    source = (
        '<html><head><title>T</title><style>p{}</style></head><body><div class="cookie-notice">We use cookies, accept '
        'them all please.</div><header>Site name</header><nav><ul><li><a href=x>Home</a></li></ul></nav><div><div class="sidebar"><p>'
        'Popular posts and more of this text, here for you.</p></div><article><h1>Title &amp; more</h1><p>First  para\n'
        'of the text, it is long enough&#33;<script>var t="</p>";</script><!-- <p>no</p> --><div class="advert">Buy now, best price of the day.</div>'
        "<p>Second <b>bold<i> part<br>next</b> line<p>Third, unclosed and long enough to read</article></div><section id=comments><h3>Comments</h3><p>Great "
        "article, I liked it very much, thanks.</p></section><form><p>Your mail</p><input></form><footer>&copy; 2020</footer>"
    )
    text = h.extract([source], trees)[0]
    assert text == (
        "Title & more\nFirst para of the text, it is long enough!\nSecond bold part next line\n"
        "Third, unclosed and long enough to read"
    )


def test_broken_and_empty_pages(spark, trees):
    odd = [
        None, "", "<", "<a", "<p", "plain words", "</p></div>", "<!-- never closed <p>x</p>", "<script>never closed",
        "<table><tr><td>a<td>b<tr><td>c</table>", "<div>" * 3000 + "deep" + "</div>" * 3000, "<" * 10_000, "&#xZZ; &nosuch; &amp",
    ]
    got = h.extract(odd, trees)
    assert len(got) == len(odd) and got[0] == got[1] == got[7] == ""
    df = spark.createDataFrame([(1, None), (1, None), (2, "<p>x</p>")], "page_id long, html string")
    assert h.extract_main_text(df, trees).count() == 3
    empty = df.limit(0)
    assert h.extract_main_text(empty, h.train(empty)).collect() == []


def value_of(page, margins, leaves):
    """Sum of the margins of some leaves and of all elements around them; nothing if an
    element that stays costs more than what stays in it brings."""
    n = len(page.tags)
    total, around = [0.0] * n, [False] * n
    for j in leaves:
        total[page.leaves[j][0]] += margins[n + j]
        around[page.leaves[j][0]] = True
    for k in range(n - 1, 0, -1):
        if around[k]:
            total[k] += margins[k]
            if total[k] <= 0:
                return -np.inf
            total[page.parents[k]] += total[k]
            around[page.parents[k]] = True
    return total[0]


def test_decoding_is_the_best_of_all_choices():
    """All sets of leaves that the trees would keep, with the elements around them, of small
    drawn pages: only a leaf's own margin may keep it, but those around it may drop it."""
    draw = np.random.default_rng(2)
    for _ in range(300):
        source, open_ = [], 0
        for k in range(draw.integers(1, 9)):
            step = draw.integers(0, 3)
            if step == 0:
                source.append("<div>")
                open_ += 1
            elif step == 1 and open_:
                source.append("</div>")
                open_ -= 1
            source.append(f"<p>t{k}</p>")
        page = h.Page("".join(source))
        n, m = len(page.tags), len(page.leaves)
        margins = np.clip(draw.normal(size=n + m) * 3, -6, 6)
        kept = h.decode(page, margins)
        got = value_of(page, margins, [j for j in range(m) if page.leaves[j][1] in kept])
        good = [j for j in range(m) if margins[n + j] > 0]
        every = [[j for at, j in enumerate(good) if bits >> at & 1] for bits in range(1 << len(good))]
        assert set(kept) <= {page.leaves[j][1] for j in good}
        assert got == pytest.approx(max(value_of(page, margins, leaves) for leaves in every))


def leaves(source):
    page = h.Page(source)
    return [text for _, text, _ in page.leaves]


@pytest.mark.parametrize(
    "source, want",
    [
        ("<article><p>one</p><object><p>a</p><p>b</p></article><p>tail</p>", ["one", "a", "b", "tail"]),
        ("<p>Energy <math><mi>E</mi></math> law</p>", ["Energy E law"]),
        ("<canvas><p>c</p><p>rest", ["c", "rest"]),
        ("<p>a<noscript>b</noscript> <svg><text>c</text></svg></p><iframe>d</iframe>", ["ab c", "d"]),
        ("<div><p>x</p><template><div>no</div></div><p>after</p>", ["x", "after"]),
        ("<div><template><div>no</div><template>n</template></template>y</div>z", ["y", "z"]),
        ("\u0130\u0130<script>x</SCRIPT>k<style>p</style>l", ["\u0130\u0130kl"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<p>a<p>b<div>c</div>d<table><tr><td>1<td>2<p>3<tr><td><p>4<p>5</table>", ["a", "b", "c", "d", "1", "2", "3", "4", "5"]),
    ],
)
def test_only_scripts_styles_and_templates_have_no_text(source, want):
    assert leaves(source) == want


def test_deeply_nested_tags_take_no_longer_each():
    begin = time.time()
    assert leaves("<div>" * 100_000 + "x") == ["x"]
    assert len(leaves("<ul><li>" + "<div>" * 50_000 + "<li>a</li>" * 20_000 + "<p>b" * 20_000)) == 40_000
    assert time.time() - begin < 20


def test_boosted_trees_learn():
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    trees = Boosted.fit(x[:2000], y[:2000], trees=40, depth=3)
    assert ((trees.margin(x[2000:]) > 0) == y[2000:]).mean() > 0.95
