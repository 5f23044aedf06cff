"""Blocks by hand, the field against sums over all labellings, extraction on the test pages and on pages held out."""

import itertools
import re
from html import unescape
from pathlib import Path

import numpy as np
import pytest

from starmart.llm import extract, labelled
from starmart.llm.blocks import blocks, stems
from starmart.llm.common import prepare, table

PAGES = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return extract.fit(labelled.pages())


def texts(html):
    return [b.text for b in blocks(html)]


@pytest.mark.parametrize("html,want", [
    (None, []), ("", []), ("  \n ", []), ("plain &amp; simple", ["plain & simple"]),
    ("<p>one<p>two<div>three</p>four</div>five", ["one", "two", "three", "four", "five"]),
    ("<p>a <b>bold</b><i> it</i>alic<br>line\n\t x&nbsp;y</p>", ["a bold italic line x y"]),
    ("<script>var t='</p><p>no';</script><style>p{}</style>yes<!-- <p>no</p> --><noscript>no</noscript>", ["yes"]),
    ("<p>kept</p><script>never closed <p>gone", ["kept"]), ("a<!-- never closed <p>gone", ["a"]),
    ("<p title='a > b'>x</p><p title=\"never closed>y</p>", ["x"]), ("1 < 2 && 3 > 2 &lt;b&gt; &am", ["1 < 2 && 3 > 2 <b> &am"]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><td>f</table>", ["a", "b", "c", "d", "e", "f"]),
    ("<select><option>no</select><textarea>no</textarea><button>no</button>yes", ["yes"]), ("</p></div></b>x</article>", ["x"]),
    ("<P CLASS=x>Up</P><![CDATA[no]]><?php no ?>", ["Up"]), ("<b><p>in</b> out</p>", ["in out"]),
])
def test_blocks(html, want):
    assert texts(html) == want


def test_features_of_ancestors():
    html = '<article class="mainStory"><div id="reader-comments"><p>x y</p></div><p>z</p></article><p>w</p>'
    first, second, third = blocks(html)
    assert {"in:article", "in:div", "named:reader", "named:comment", "named:main", "named:story", "own:p"} <= set(first.features)
    assert "named:comment" not in second.features and "in:article" in second.features and "in:article" not in third.features
    assert stems("ads siteHeader PRESS Class") == {"ad", "site", "header", "press", "class"}


def test_hard_pages_end():
    for html in ("<div>" * 20_000 + "deep", "<b>" * 20_000 + "x" + "</b>" * 20_000, "<a \"" * 50_000, "<a x=\"" * 50_000, "<!--" * 50_000, "&" * 200_000,
                 "<li>" * 20_000 + "x", "<ul><li>" * 5_000 + "x", "</p>" * 50_000, "<" * 200_000, "<a " * 50_000, "<script>" * 50_000):
        assert len(blocks(html, {}.get)) <= 2


def test_field_against_all_labellings():
    """Best path and likelihood by trying every labelling."""
    pages = [p for p in labelled.pages(range(0, 12))]
    model = extract.fit(pages, steps=30)
    for page in pages:
        chain = blocks(page, model.numbers.get)[:9]

        def score(labels):
            total = 0.0
            for t, (block, label) in enumerate(zip(chain, labels)):
                total += label * (model.weights[0] + sum(model.weights[f] for f in block.features))
                if t:
                    total += model.pairs[int(chain[t - 1].parent == block.parent)][labels[t - 1]][label]
            return total

        best = max(itertools.product((0, 1), repeat=len(chain)), key=score)
        assert score(tuple(map(int, extract.decode(model, chain)))) == pytest.approx(score(best))


def test_gradient_leads_to_a_stationary_point():
    """At the fitted weights, expected feature counts (over all labellings) meet the observed ones but for the penalty."""
    pages = ["<p data-main>One two.</p><p>x</p>", "<p>x</p><div data-main>One two.</div><p>x</p>"]
    model = extract.fit(pages, steps=3000, penalty=0.5)
    slope, total = np.zeros(len(model.numbers) + 1), 0
    for page in pages:
        chain, truth = blocks(page, model.numbers.get), [b.main for b in blocks(page)]
        ways = list(itertools.product((0, 1), repeat=len(chain)))
        scores = np.array([sum(y * (model.weights[0] + sum(model.weights[f] for f in b.features)) for b, y in zip(chain, way))
                           + sum(model.pairs[int(chain[t].parent == chain[t - 1].parent)][way[t - 1]][way[t]] for t in range(1, len(way))) for way in ways])
        chance = np.exp(scores - scores.max()) / np.exp(scores - scores.max()).sum()
        for t, block in enumerate(chain):
            expected = sum(c for c, way in zip(chance, ways) if way[t])
            slope[[0, *block.features]] += expected - truth[t]
            total += 1
    assert np.abs(slope / total + 0.05 * np.array(model.weights)).max() < 1e-3


@pytest.mark.parametrize("every,least", [(7, 0.97), (4, 0.9)])
def test_pages_held_out(every, least):
    """Learning without every 7th page leaves each article and each part seen elsewhere; without every 4th, a quarter of the articles and
    a quarter of the parts inside them have never been seen."""
    pages = labelled.pages()
    model = extract.fit([p for i, p in enumerate(pages) if i % every])
    told = found = wanted = 0
    for page in pages[::every]:
        for block, main in zip(blocks(page), extract.decode(model, blocks(page, model.numbers.get))):
            told, found, wanted = told + main, found + (main and block.main), wanted + block.main
    assert found / told > least and found / wanted > least


def plain_article(html):
    """For the test pages, whose article is one element of h1 and p."""
    inside = re.search(r"<article>(.*?)(</article>|\Z)", html, re.S)[1]
    lines = unescape(re.sub("<[^>]*>", " ", re.sub(r"</?(?:p|h1)>", "\n", inside))).split("\n")
    return "\n".join(x for x in (" ".join(line.split()) for line in lines) if x)


@pytest.mark.skipif(not Path(PAGES).exists(), reason="no test tables here")
def test_test_pages(spark):
    source = {r.page_id: r for r in table(spark, PAGES, "pages").collect()}
    got = extract.extract(table(spark, PAGES, "pages"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert sorted(r.page_id for r in rows) == sorted(source)
    for r in rows:
        assert r.url == source[r.page_id].url and r.text == plain_article(source[r.page_id].html) and r.n_chars == len(r.text)


def test_odd_tables(spark):
    prepare(spark)
    rows = [(1, "u", None, "x", 3), (1, "u", None, "x", 3), (None, None, "", "x", 3), (2, "v", "<article><p>" + "Long words here, and more. " * 40_000 + "</p></article>", "x", 3),
            (3, "w", "<nav><a>Home</a></nav><div class=ad>Buy two of these today.</div>", "x", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted(map(tuple, extract.extract(pages).collect()), key=lambda r: (r[0] or 0, r[3]))
    assert [(r[0], r[3]) for r in got] == [(None, 0), (1, 0), (1, 0), (2, 27 * 40_000 - 1), (3, 0)]
    assert extract.extract(pages.limit(0)).count() == 0
    own = spark.createDataFrame([("<p data-main>Yes it is.</p><div>No</div>",), (None,)] * 3, "html string")
    assert extract.extract(spark.createDataFrame([(1, "u", "<div>No</div><p>So it is.</p>")], "page_id int, url string, html string"), own).first().text == "So it is."
    assert extract.train(own.limit(0)) is None and extract.main_text(None, "<p>a<p>b") == "a\nb"
