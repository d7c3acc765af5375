"""HTML extraction by a tree-structured graphical model: every node of a page is main text or not.

Each block element and each run of text is a variable with two values; each is tied to its parent by potentials that its
own features weigh: for entering the main text, leaving it and staying in it. Features are the element's name, the words
of its class, id and role, its parent, and how much of the page's text and of links lies below. Sum-product messages go
up from the leaves and down from the root, exactly, as a page is a tree; runs whose marginal is at least one half are the
text, in page order.

The potentials are learnt from labelled pages: those of the corpus that mark their text by one ``article`` (or ``main``)
element, a bounded sample of them, and made pages, which put texts of the sample into other layouts, among menus,
notices, adverts, forms, comments and the like, with the marks left out as often as not. Training climbs the exact
conditional likelihood.

Defined cases: null and empty pages have empty text; so do pages where no run reaches one half. Pages cut off anywhere
are read to their end. A very long page is read whole, alone in its block. Nothing is capped. Rows of one page_id stay
rows of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import random
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natspark.llm.pages import RUN, Node, tree
from natspark.llm.tokens import blocks

#: Pages that teach at most, whole rows of the table; made pages for each of them; longer pages don't teach.
SAMPLE = 160
MADE = 3
SAMPLE_BYTES = 30_000
SEED = 42
_ROUNDS, _RATE, _PENALTY = 150, 0.3, 2e-4
#: Pairs of (parent, child) values: outside both, entering, leaving, inside both. The first is the reference.
_ENTER, _LEAVE, _STAY = range(3)
_MAIN, _REST = "labelmain", "labelrest"


@dataclass(frozen=True)
class Model:
    """Weights of entering, leaving and staying for each feature."""

    weights: dict[str, tuple[float, float, float]]


_CHARS, _SHARE, _LINKED, _PROSE = (1, 20, 60, 150, 400, 1500, 6000), (0.02, 0.1, 0.3, 0.6, 0.9), (0.01, 0.3, 0.7), (1, 2, 4)


def views(nodes: list[Node]) -> list[tuple]:
    """What is seen of each node: its own names and, of what lies below it, amounts in steps."""
    n = len(nodes)
    chars, linked, prose = [0] * n, [0] * n, [0] * n
    for k in range(n - 1, -1, -1):
        node = nodes[k]
        if node.tag == RUN:
            chars[k] = len(node.text)
            linked[k], prose[k] = min(node.linked, chars[k]), chars[k] >= 80
        if k:
            p = node.parent
            chars[p] += chars[k]
            linked[p] += linked[k]
            prose[p] += prose[k]
    whole, out = max(chars[0], 1), []
    for k, node in enumerate(nodes):
        parent = nodes[node.parent].tag if k else ""
        amount, link = bisect_right(_CHARS, chars[k]), bisect_right(_LINKED, linked[k] / max(chars[k], 1))
        if node.tag == RUN:
            out.append((RUN, parent, amount, link, node.text[-1].isalnum()))
        else:
            out.append((node.tag, parent, amount, link, node.names, bisect_right(_SHARE, chars[k] / whole), bisect_right(_PROSE, prose[k])))
    return out


def features(view: tuple) -> list[str]:
    """The features of a node, by name."""
    tag, parent, amount, link, *more = view
    if tag == RUN:
        return [f"run in {parent}", f"run {amount}", f"run linked {link}", f"run ends {more[0]}", "run"]
    names, share, prose = more
    of = [f"tag {tag}", f"tag {tag} in {parent}", *(f"name {w}" for w in dict.fromkeys(names)), "block", f"chars {amount}", f"share {share}", f"linked {link}", f"prose {prose}"]
    of += [f"div share {share} linked {link}"] if tag in ("div", "section", "td", "body") else []
    return of + ["named"] if names else of


class Forest:
    """Trees as arrays: parents, and the nodes of each depth."""

    def __init__(self, pages: list[list[Node]]):
        sizes = np.array([len(p) for p in pages], np.int64)
        first = np.cumsum(sizes) - sizes
        self.parent = np.array([b + node.parent if node.parent >= 0 else -1 for b, p in zip(first.tolist(), pages) for node in p], np.int64)
        depth = np.zeros(len(self.parent), np.int64)
        for k, p in enumerate(self.parent.tolist()):
            if p >= 0:
                depth[k] = depth[p] + 1
        order = np.argsort(depth, kind="stable")
        cuts = np.cumsum(np.bincount(depth)) if len(depth) else np.array([], np.int64)
        self.levels = np.split(order, cuts[:-1]) if len(depth) else []

    def marginals(self, scores: np.ndarray) -> np.ndarray:
        """For each node the probabilities of (parent, child) values 00, 01, 10, 11, by sum-product messages up and down.
        ``scores``: weights of entering, leaving and staying; the root's parent is outside."""
        n = len(self.parent)
        pair = np.zeros((n, 2, 2))
        pair[:, 0, 1], pair[:, 1, 0], pair[:, 1, 1] = scores[:, _ENTER], scores[:, _LEAVE], scores[:, _STAY]
        below, up = np.zeros((n, 2)), np.zeros((n, 2))
        for level in self.levels[:0:-1]:
            up[level] = np.logaddexp.reduce(pair[level] + below[level][:, None, :], axis=2)
            np.add.at(below, self.parent[level], up[level])
        out, above = np.zeros((n, 2, 2)), np.zeros((n, 2))
        for depth, level in enumerate(self.levels):
            if depth:
                p = self.parent[level]
                before = above[p] + below[p] - up[level]
            else:
                before = np.tile([0.0, -1e9], (len(level), 1))
            joint = before[:, :, None] + pair[level] + below[level][:, None, :]
            joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
            out[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
            above[level] = np.logaddexp.reduce(before[:, :, None] + pair[level], axis=1)
        return out.reshape(n, 4)


def _scores(model: Model, seen: list[tuple]) -> np.ndarray:
    """The potentials' weights for each node; nodes that look alike are scored once."""
    known, none = model.weights, (0.0, 0.0, 0.0)
    place: dict[tuple, int] = {}
    of = [place.setdefault(view, len(place)) for view in seen]
    each = np.array([np.sum([known.get(f, none) for f in features(view)], axis=0) for view in place]).reshape(-1, 3)
    return each[np.array(of, np.int64)]


def main_text(model: Model, pages: list[str | None]) -> list[str]:
    """The text of each page."""
    trees = [tree(p) for p in pages]
    inside = Forest(trees).marginals(_scores(model, [view for nodes in trees for view in views(nodes)])).reshape(-1, 2, 2)[:, :, 1].sum(axis=1) >= 0.5
    out, at = [], 0
    for nodes in trees:
        out.append("\n".join(node.text for node, chosen in zip(nodes, inside[at : at + len(nodes)].tolist()) if chosen and node.tag == RUN))
        at += len(nodes)
    return out


# ---- labelled pages


#: Tags that stand for no part of the text, even inside its element.
_NEVER = {"nav", "aside", "footer", "form", "button", "select", "menu", "dialog"}


def labels_of_markup(nodes: list[Node]) -> list[bool] | None:
    """Labels of a page that marks its text by one ``article`` or, without any, one ``main``; else none."""
    marks = next((m for t in ("article", "main") if (m := [k for k, node in enumerate(nodes) if node.tag == t])), [])
    if len(marks) != 1:
        return None
    inside: list[bool] = []
    for k, node in enumerate(nodes):
        inside.append(k == marks[0] or (k > 0 and inside[node.parent] and node.tag not in _NEVER))
    return inside


def labels_of_made(nodes: list[Node]) -> list[bool]:
    """Labels of a made page, from the marks among its names, which go."""
    inside: list[bool] = []
    for node in nodes:
        inside.append(_MAIN in node.names or (bool(inside) and inside[node.parent] and _REST not in node.names))
        node.names = tuple(w for w in node.names if w not in (_MAIN, _REST))
    return inside


#: Made layouts: elements and the names that sites give to their parts.
_PARTS = {
    "menu": (["nav", "div", "ul", "header", "aside"], "nav navbar menu main-menu site-nav navigation breadcrumb breadcrumbs topbar toolbar tabs pagination pager toc skip links"),
    "header": (["header", "div"], "header site-header masthead page-header banner top logo brand branding"),
    "footer": (["footer", "div"], "footer site-footer page-footer foot bottom copyright legal colophon credits"),
    "sidebar": (["aside", "div", "section"], "sidebar side-bar aside widget widgets related related-posts recommended popular trending teaser more-stories read-next rail"),
    "notice": (["div", "section", "p", "aside", "dialog"], "notice cookie cookies cookie-banner consent gdpr alert popup modal overlay message warning paywall subscribe disclaimer"),
    "advert": (["div", "aside", "section", "ins"], "ad ads advert advertisement adbox ad-slot sponsor sponsored promo promotion banner-ad commercial"),
    "form": (["form", "div"], "form search search-form login signup newsletter newsletter-form contact subscribe-form"),
    "share": (["div", "ul"], "share social sharing share-buttons follow tags meta tools print"),
    "comments": (["section", "div", "aside", "ol"], "comments comment comment-list comments-area discussion responses replies reader-comments disqus feedback"),
}
_MAINS = (["article", "main", "div", "section", "td"], "article content main post entry story post-content entry-content article-body main-content story-body text body page-content hentry")
_IN_MAIN = ["menu", "sidebar", "advert", "share", "comments", "notice", "form"]
_WORDS = "Home News About Contact Login Search Menu Share Reply Sign up Accept Close Next Previous Top More".split()


class Maker:
    """Made pages, from runs of real ones."""

    def __init__(self, prose: list[str], seed: int):
        self.rng, self.prose = random.Random(seed), prose or [f"{a} {b} {c}." for a, b, c in zip(_WORDS, _WORDS[3:], _WORDS[7:])]

    def _open(self, tags: list[str], names: str, label: str, bare: float) -> tuple[str, str]:
        """A start tag with a label and, but for the share ``bare`` of plain tags that say enough, a name."""
        tag = self.rng.choice(tags)
        name = "" if tag not in ("div", "section", "p", "td", "ul", "ol", "ins") and self.rng.random() < bare else self.rng.choice(names.split())
        return tag, f'<{tag} {self.rng.choice(["class", "id"])}="{name}" role="{label}">' if name else f'<{tag} role="{label}">'

    def _sentence(self) -> str:
        text = self.rng.choice(self.prose)
        words = text.split()
        begin = self.rng.randrange(len(words))
        return " ".join(words[begin : begin + self.rng.choice((3, 8, 20, 60))]).replace("<", "&lt;")

    def _links(self) -> str:
        form = self.rng.choice(("<li><a href='/'>{}</a></li>", "<a href='/'>{}</a> ", "<p><a href='/'>{}</a></p>"))
        return "".join(form.format(self.rng.choice((self.rng.choice(_WORDS), self._sentence()[:40]))) for _ in range(self.rng.randrange(2, 9)))

    def part(self, kind: str) -> str:
        tag, start = self._open(*_PARTS[kind], _REST, 0.6)
        text = f"<p>{self._sentence()}</p>" if self.rng.random() < 0.6 else self._sentence()
        if kind in ("menu", "share"):
            inner = self._links() if self.rng.random() < 0.85 else text
        elif kind == "form":
            inner = f"<label>{self.rng.choice(_WORDS)}</label><input><button>{self.rng.choice(_WORDS)}</button>" + (text if self.rng.random() < 0.5 else "")
        elif kind == "comments":
            one = self.rng.choice(("<div class='comment'><p>{}</p></div>", "<li><b>{}</b><p>{}</p></li>", "<p>{}</p>", "<article class='comment'><p>{}</p></article>"))
            inner = "<h3>Comments</h3>" * self.rng.randrange(2) + "".join(one.format(self.rng.choice((self._sentence(), self.rng.choice(self.prose))), self._sentence()) for _ in range(self.rng.randrange(1, 5)))
        else:
            inner = self.rng.choice((text, f"<h3>{self._sentence()[:30]}</h3>{text}", self._links(), f"<ul>{self._links()}</ul>", self.rng.choice(self.prose)))
        return f"{start}{inner}</{tag}>"

    def _block(self, text: str) -> str:
        text = text.replace("&", "&amp;").replace("<", "&lt;")
        kind = self.rng.random()
        if kind < 0.75:
            return f"<p>{text}</p>"
        if kind < 0.81:
            return f"<h2>{text[:50]}</h2><p>{text}</p>"
        if kind < 0.86:
            return f"<ul><li>{text}</li><li>{text[:30]}</li></ul>"
        if kind < 0.9:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.93:
            return f"<figure><figcaption>{text[:60]}</figcaption></figure>"
        if kind < 0.96:
            return f"<div><p>{text}</p></div>"
        return f"<table><tr><td>{text[:40]}</td><td>{text[:20]}</td></tr></table>"

    def page(self, title: str, blocks: list[str]) -> str:
        if self.rng.random() < 0.15:
            blocks = [b[: self.rng.choice((3, 12, 40))] for b in blocks]
        tag, start = self._open(*_MAINS, _MAIN, 0.7)
        heading = f"<h1>{title}</h1>"
        heading = f"<header>{heading}</header>" if self.rng.random() < 0.2 else heading
        body = [self._block(b) for b in blocks]
        if self.rng.random() < 0.15:
            body = [" ".join(blocks) if len(body) == 1 else "<br><br>".join(blocks)]
        for _ in range(self.rng.choice((0, 0, 1, 1, 2))):
            body.insert(self.rng.randrange(len(body) + 1), self.part(self.rng.choice(_IN_MAIN)))
        if self.rng.random() < 0.35:
            body.append(self.part("comments"))
        inner = "".join(body)
        if self.rng.random() < 0.2:
            inner = f"<div class='{self.rng.choice(_MAINS[1].split())}'>{inner}</div>"
        main = f"{start}{heading}{inner}</{tag}>"
        many = self.rng.choice((0, 0.3, 0.6, 0.6))
        parts = [self.part(k) for k in _PARTS if self.rng.random() < many]
        self.rng.shuffle(parts)
        cut = self.rng.randrange(len(parts) + 1)
        before, after = "".join(parts[:cut]), "".join(parts[cut:])
        if self.rng.random() < 0.12:  # nothing but the page itself holds the text
            before, after = self.rng.choice(((before, after), ("", "")))
            return f"<html><head><title>{title}</title></head><body role='{_MAIN}'>{before}{heading}{inner}{after}</body></html>"
        if tag == "td":
            main = f"<table><tr>{main}</tr></table>"
        for _ in range(self.rng.choice((0, 0, 1, 2))):
            name = self.rng.choice(("container", "wrapper", "page", "row", "layout", "site", "col", "inner"))
            if self.rng.random() < 0.5:
                before, main, after = before, f"<div class='{name}'>{main}</div>", after
            else:
                before, main, after = "", f"<div id='{name}'>{before}{main}{after}</div>", ""
        return f"<html><head><title>{title}</title></head><body>{before}{main}{after}</body></html>"


def fit(pages: list[str], made: int = MADE, seed: int = SEED) -> Model:
    """Potentials from pages, some of which mark their text; without any, from made pages alone."""
    trees, labels, articles = [], [], []
    for html in pages:
        nodes = tree(html)
        inside = labels_of_markup(nodes)
        runs = [node.text for k, node in enumerate(nodes) if node.tag == RUN and (inside[k] if inside else len(node.text) >= 80)]
        if inside:
            trees.append(nodes), labels.append(inside)
        if runs:
            articles.append(runs)
    prose = [text for runs in articles for text in runs[:20]]
    maker = Maker(prose, seed)
    for runs in (articles or [_WORDS]) * made:
        blocks_ = runs[1:] or runs
        nodes = tree(maker.page(runs[0], blocks_[: maker.rng.choice((1, 2, 4, 8, 30))]))
        labels.append(labels_of_made(nodes)), trees.append(nodes)
    seen = [features(view) for nodes in trees for view in views(nodes)]
    index = {f: k for k, f in enumerate(sorted({f for of in seen for f in of}))}
    row = np.repeat(np.arange(len(seen)), [len(of) for of in seen])
    column = np.array([index[f] for of in seen for f in of], np.int64)
    forest = Forest(trees)
    inside = np.array([x for of in labels for x in of], np.int64)
    parent_inside = np.where(forest.parent >= 0, inside[forest.parent], 0)
    truth = np.eye(4)[2 * parent_inside + inside]
    weights, first, second = (np.zeros((len(index), 3)) for _ in range(3))
    for step in range(1, _ROUNDS + 1):
        scores = np.stack([np.bincount(row, weights[column, k], len(seen)) for k in range(3)], axis=1)
        miss = (forest.marginals(scores) - truth)[:, 1:]
        slope = np.stack([np.bincount(column, miss[row, k], len(index)) for k in range(3)], axis=1) / len(trees) + _PENALTY * weights
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights -= _RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6) * min(1, 2 - 2 * step / _ROUNDS)
    return Model({f: tuple(weights[k].tolist()) for f, k in index.items()})


def learn(pages: DataFrame, sample: int = SAMPLE, made: int = MADE) -> Model:
    """Potentials from the corpus's pages: the ``sample`` of those that mark their text with the least hashes, so that
    reruns agree. Only that sample comes to the driver."""
    html = F.col("html").cast("string")
    order = F.xxhash64(html)
    rows = pages.select(html.alias("html"), order.alias("order")).where(html.rlike("(?i)<(article|main)[\\s>]") & (F.length(html) <= SAMPLE_BYTES))
    # Hashes are chosen first, so that no page moves that isn't in the sample.
    chosen = [r.order for r in rows.select("order").distinct().orderBy("order").limit(sample).collect()]
    taught = rows.where(F.col("order").isin(chosen)).distinct().orderBy("order", "html").limit(sample)
    return fit([r.html for r in taught.collect()], made)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id, url, text`` of every page: one pass, no shuffle; the model, bounded by the sample, goes with the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in (b for batch in batches for b in blocks(batch, "html", 1 << 20)):
            texts = main_text(model, block.column("html").to_pylist())
            yield pa.RecordBatch.from_arrays([block.column("page_id"), block.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    wanted = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return wanted.mapInArrow(run, "page_id long, url string, text string")


#: The rows that markup gives where every page marks its text by one ``article`` of headings and paragraphs, as those of
#: ``pages`` do: the marks teach the model, and its verdicts are held against them.
ORACLE = r"""
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM (
  SELECT page_id, url, coalesce(array_to_string(list_filter(list_transform(
      regexp_split_to_array(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '</?(?:p|h1)>'),
      lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        regexp_replace(x, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g'), '&quot(;|$)', '"', 'g'), '&lt(;|$)', '<', 'g'), '&gt(;|$)', '>', 'g'), '&amp(;|$)', '&', 'g'), '\s+', ' ', 'g'))),
    lambda x: x <> ''), chr(10)), '') AS text
  FROM pages)
"""
