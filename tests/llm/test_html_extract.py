from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from sessionsmith.llm import html_extract as H
from sessionsmith.llm.dom import blocks, parsed


@pytest.fixture(scope="module")
def model():
    return H.trained([])


def text_of(source):
    page = parsed(source)
    return blocks(page, [True] * len(page.tag))


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<p>a &amp; b&lt;<br>c&nbsp;d  e <b>x<i>y</b>z</i><p>q", "a & b< c d e xyz\n\nq"),
        ("<ul><li>a<li>b</ul>t<table><tr><td>1<td>2<tr><td>3</table>", "a\n\nb\n\nt\n\n1\n\n2\n\n3"),
        ("<div>a<p>b</div>c<script>var x='</p>';</script><style>p{}</style><!-- no <p> -->d", "a\n\nb\n\ncd"),
        ('<a title="x>y">in</a> <a href="broken>out</a> end', "in out end"),
        ("a < b, 1<2 <p", "a < b, 1<2"),
        ("<title>no</title><textarea>no</textarea>yes<script>never ends", "yes"),
        ("", ""),
        ("&eacute;&#233;&#xe9;&copy &bogus;", "ééé© &bogus;"),
        ("</p></div>x<div/>y", "x\n\ny"),
    ],
)
def test_parsing(source, want):
    assert text_of(source) == want


def test_deep_pages():
    assert text_of("<div>" * 30_000 + "x" + "</p></div>" * 30_000 + "y") == "x\n\ny"


def test_marginals_against_enumeration():
    """On small random trees, messages give the marginals that summing over all states gives."""
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 9):
        parent = np.array([-1] + [int(rng.integers(0, i)) for i in range(1, n)])
        depth = np.zeros(n, np.int64)
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        unary, kinds, edge = rng.normal(size=n), rng.integers(0, 3, n), rng.normal(size=(3, 2, 2))
        weight, share, pairs = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for states in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(unary[i] * states[i] for i in range(n)) + sum(edge[kinds[i], states[parent[i]], states[i]] for i in range(1, n)))
            weight += w
            share += w * np.array(states)
            for i in range(1, n):
                pairs[i, states[parent[i]], states[i]] += w
        got, joint = H.marginals(parent, H.levels(depth), unary, kinds, edge)
        assert np.allclose(got, share / weight)
        assert np.allclose(joint[1:], pairs[1:] / weight)


def test_held_out_pages(model):
    rng = random.Random(12345)
    exact = 0
    for _ in range(150):
        source = H.made_page(rng)
        page = parsed(source)
        want = blocks(page, H.labelled_by_marks(page))
        exact += H.extracted([re.sub(r' data-content="\d"', "", source)], model, {})[0] == want
    assert exact >= 140


def test_table(spark, model):
    rows = [(r.page_id, r.html) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    got = H.main_text(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), ["page_id", "url"]).collect()
    text = {r.page_id: r.text for r in got}
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == len(rows)
    for i, source in rows:
        article = re.search("<article>(.*?)(</article>|$)", source, re.S)
        assert text[i] == text_of(article[0])


def test_edges(spark):
    long = "<article><h1>t</h1>" + "<p>some words here.</p>" * 50_000 + "</article>"
    rows = [(None, None), (1, ""), (2, "<nav><a href=x>menu</a></nav>"), (3, long), (3, long), (4, "<article><p>One two three. Four!</p></article><footer>&copy; x</footer>")]
    df = spark.createDataFrame(rows, "page_id bigint, html string").selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS url")
    got = {(r.page_id, r.text, r.n_chars) for r in H.main_text(df, ["page_id"]).collect()}
    whole = text_of(long)
    assert got == {(None, "", 0), (1, "", 0), (2, "", 0), (3, whole, len(whole)), (4, "One two three. Four!", 20)}
    assert H.main_text(spark.createDataFrame([], "page_id bigint, html string"), ["page_id"]).collect() == []
