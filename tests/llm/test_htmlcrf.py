from __future__ import annotations

import re
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselake.llm.htmlblocks import blocks
from caselake.llm.htmlcrf import MAIN, ChainModel, PageMaker, extract_main_text, features, fitted, labelled_pages, main_text, train

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu".split()


@pytest.fixture(scope="module")
def model():
    return train(labelled_pages(WORDS))


def texts(html):
    return [b.text for b in blocks(html)]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>a<b>b</b>c<p>d &amp; &#233;<br>e</p>", ["abc", "d & é e"]),
        ("<p>x<script>var t='</p><p>no';</script>y</p>", ["xy"]),
        ("<style>p{}</style><title>t</title><!-- <p>no</p> --><p>yes", ["yes"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>d", ["a", "b", "c", "d"]),
        ("<p>a < b and <3</p>", ["a < b and <3"]),
        ("</div></p>a<div", ["a<div"]),
        ("<P CLASS=x>A</P><select><option>no</select><p>B", ["A", "B"]),
        ("<p>&nbsp; a &nbsp; b\t</p>", ["a b"]),
        ('<p title="a > b">q</p>', ["q"]),
        ("<script>never closed <p>x</p>", []),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ],
)
def test_blocks(html, expected):
    assert texts(html) == expected


def test_deep_and_broken_pages_are_read_in_good_time():
    assert texts("<div>" * 30_000 + "x") == ["x"]
    assert len(texts("<p>y</i></b>" * 20_000)) == 20_000
    assert texts("<" * 20_000) == ["<" * 20_000]


def test_held_out_pages(model):
    maker, wrong, seen = PageMaker(WORDS, seed=77), 0, 0
    for _ in range(200):
        html, labels = maker.page()
        found = model.decode(features(blocks(html)))
        wrong += sum(a != b for a, b in zip(found, labels))
        seen += len(labels)
    assert wrong <= 0.01 * seen


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(1)
    page = [[f"f{i}"] for i in range(7)]
    for _ in range(20):
        m = ChainModel({f"f{i}": i for i in range(7)}, rng.normal(size=(7, 2)), rng.normal(size=(2, 2)))

        def score(labels):
            own = sum(m.weights[i, x] for i, x in enumerate(labels))
            return own + sum(m.moves[a, b] for a, b in zip(labels, labels[1:]))

        best = max((tuple(n >> i & 1 for i in range(7)) for n in range(128)), key=score)
        assert tuple(m.decode(page)) == best


def test_an_article_among_everything_else(model):
    html = """<html><head><title>no</title></head><body><header>Site</header><nav><a href=/>Home</a></nav>
    <div class="cookie-notice"><p>We use cookies.</p></div><article><h1>The title</h1><p>First   paragraph &mdash; here.</p>
    <div class="ad">Buy this now.</div><p>Second one, which is a little longer than the first.</p>
    <div class="comments"><h3>Comments</h3><div class="comment"><p>I like it very much.</p></div></div></article>
    <aside class="sidebar"><p>Also read</p></aside><form><label>Mail</label><input></form><footer>&copy; Site</footer></body>"""
    lines = ["The title", "First paragraph — here.", "Second one, which is a little longer than the first."]
    assert main_text(html, model) == "\n".join(lines)


def test_pages_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for row in extract_main_text(pages, fitted(pages)).collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S)[1].replace("<br>", " ")
        lines = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|h2|li|ul)>", article)]
        assert row.text == "\n".join(x for x in lines if x) and row.n_chars == len(row.text)


def test_edge_rows(spark, model):
    rows = [(1, None), (1, None), (2, ""), (None, "<nav>x</nav>"), (3, "<article>" + "<p>long text here.</p>" * 5000)]
    pages = spark.createDataFrame(rows, "page_id int, html string")
    wide = pages.withColumns({n: F.lit(f"own {n}") for n in ("row", "text", "n_chars", "label", "url")})
    found = extract_main_text(wide, model)
    assert sorted(found.columns) == sorted(wide.columns)
    assert found.filter("text = '' AND n_chars = 0").count() == 4 and found.filter("row = 'own row'").count() == 5
    assert found.filter("page_id = 3").first().text.count("\n") == 4999
    assert extract_main_text(pages.limit(0), model).count() == 0 and MAIN == 1
