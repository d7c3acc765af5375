"""Extraction: reading of markup, exact messages, texts of the given pages, other layouts, and rows that it must bear."""

import itertools
import re
from html import unescape

import numpy as np
import pytest

from natspark.llm import extraction
from natspark.llm.pages import RUN, tree
from natspark.llm.queries import op13_extraction

SCHEMA = "page_id long, url string, html string, text string, n_chars int"


@pytest.fixture(scope="module")
def given(spark):
    return {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}


@pytest.fixture(scope="module")
def model(given):
    return extraction.fit([given[k] for k in sorted(given)][:120])


def runs(html):
    return [(node.text, node.linked > 0) for node in tree(html) if node.tag == RUN]


def test_markup():
    assert runs("<p>a <b>b</b>c<br>d&amp;&eacute;&#65;&nbsp; e<p>f") == [("a bc d&éA e", False), ("f", False)]
    assert runs("<p><b>x<br><p>y</p>z") == [("x", False), ("y", False), ("z", False)]
    assert runs("<head><title>t</title><style>a>b{}</style><body>x<script>var t='</p>';</script>y<!-- c > d -->z") == [("xyz", False)]
    assert runs("<ul><li><a href='/a>b'>q</a><li>r</ul>1 < 2 <3") == [("q", True), ("r", False), ("1 < 2 <3", False)]
    assert runs("<div>a<span>b<div>c</div>d</span>e</div><noscript>n</noscript><foo") == [("ab", False), ("c", False), ("de", False)]
    assert runs("<table><tr><td>1<td>2<tr><td>3</table>&am &amp") == [("1", False), ("2", False), ("3", False), ("&am &", False)]
    assert runs(None) == runs("") == runs(" \n<br>&nbsp;") == runs("<!-- never closed") == []
    assert [n.names for n in tree('<div class="site-Header adBox" id=top hidden>')][1] == ("site", "header", "ad", "box", "top", "hidden")
    assert runs("<div>" * 3000 + "x") == [("x", False)]


def test_messages_are_exact():
    """Against the sum over all labellings of a small tree."""
    rng = np.random.default_rng(3)
    nodes = tree("<div>a<p>b<i>c</i></p><ul><li>d</li></ul></div>e")
    scores = rng.normal(size=(len(nodes), 3)) * 2
    total, pairs = 0.0, np.zeros((len(nodes), 4))
    for values in itertools.product((0, 1), repeat=len(nodes)):
        kind = [2 * (values[n.parent] if k else 0) + v for k, (n, v) in enumerate(zip(nodes, values))]
        weight = np.exp(sum(scores[k, s - 1] for k, s in enumerate(kind) if s))
        total += weight
        pairs[np.arange(len(nodes)), kind] += weight
    forest = extraction.Forest([nodes, nodes])
    got = forest.marginals(np.concatenate([scores, scores]))
    assert np.allclose(got[: len(nodes)], pairs / total) and np.allclose(got[len(nodes) :], pairs / total)


def marked(html):
    inside = re.search("<article>(.*?)</article>", html, re.S)[1]
    texts = [" ".join(unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", inside)]
    return "\n".join(t for t in texts if t)


def test_given_pages(spark, given):
    """The query gives every page's marked text, of pages that taught and of others."""
    got = {r.page_id: r for r in op13_extraction(spark, "/root/testdata/sf0.01").collect()}
    assert {k: r.text for k, r in got.items()} == {k: marked(h) for k, h in given.items()}
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_marks_are_not_needed(given, model):
    """The same pages without the element that marks their text."""
    pages = [given[k] for k in sorted(given)][120:]
    for name in ('div class="post-content"', "main", 'div id="story"'):
        other = [re.sub("<article>", f"<{name}>", h).replace("</article>", f"</{name.split()[0]}>") for h in pages]
        right = sum(a == marked(h) for a, h in zip(extraction.main_text(model, other), pages))
        assert right >= 0.97 * len(pages)


def test_made_layouts(given, model):
    """Layouts drawn anew, with the runs of pages that didn't teach."""
    sets = [[t for t, _ in runs(given[k]) if len(t) > 40] for k in sorted(given)[120:]]
    maker = extraction.Maker([t for s in sets for t in s], 7)
    wrong = total = 0
    for texts in (s for s in sets if s):
        nodes = tree(maker.page(texts[0], texts[1:9] or texts))
        labels = extraction.labels_of_made(nodes)
        inside = extraction.Forest([nodes]).marginals(extraction._scores(model, extraction.views(nodes)))
        chosen = inside[:, 1] + inside[:, 3] >= 0.5
        of = [k for k, node in enumerate(nodes) if node.tag == RUN]
        wrong, total = wrong + sum(chosen[k] != labels[k] for k in of), total + len(of)
    assert total > 1000 and wrong <= 0.03 * total


def test_parts_of_an_article(model):
    page = """<body><header class="site-header"><a href=/>Site</a></header><div class="cookie-banner">We use cookies to improve this site for all of its readers.</div>
    <article><h1>A title of the thing</h1><p>The first paragraph has many words in it, and goes on for a while so as to be prose.</p>
    <div class="ad">Buy now this great product, it is the best product of all.</div><p>Short one.</p><p>And the last paragraph &lt;here&gt; has its words, too, and ends the text.</p>
    <section class="comments"><h3>Comments</h3><p>I think that this was a good text and would like to read many more of its kind.</p></section></article>
    <form><p>Subscribe to our newsletter</p><button>Go</button></form><footer>Copyright of the site</footer>"""
    want = "A title of the thing\nThe first paragraph has many words in it, and goes on for a while so as to be prose.\nShort one.\nAnd the last paragraph <here> has its words, too, and ends the text."
    assert extraction.main_text(model, [page, None, ""]) == [want, "", ""]


def test_rows(spark, given):
    pages = list(given.values())
    long = "<body><nav><a href=/>x</a></nav><article><h1>t</h1>" + "<p>Many words of one long page that goes on and on.</p>" * 20_000 + "</article>"
    rows = [(1, "u", pages[0]), (1, "u", pages[0]), (2, None, None), (None, "v", pages[1]), (3, "w", ""), (4, "x", long), (5, "y", "<p>a" * 5), (6, "z", pages[2][: len(pages[2]) // 2])]
    table = spark.createDataFrame([(*r, "t", 1) for r in rows], SCHEMA).repartition(3)
    model = extraction.learn(table)
    got = extraction.extract(table, model).collect()
    assert sorted((r.page_id or 0, r.url or "") for r in got) == sorted((r[0] or 0, r[1] or "") for r in rows)
    of = {r.page_id: r.text for r in got}
    assert of[2] == of[3] == "" and of[1] == marked(pages[0]) and of[4].count("\n") == 20_000 and of[6]


def test_empty(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert extraction.extract(table, extraction.learn(table)).collect() == []
