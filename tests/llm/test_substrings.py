import hashlib

import numpy as np
import pytest

from natspark.llm import substrings

from .fixtures import HARD, docs_of, prose


def brute(rows, window):
    """Windows by doc_id, those without one last; rows with one doc_id don't precede each other."""
    first = {}
    order = lambda d: (d is None, d or 0)
    texts = [(r[0], (r[1] or "").encode().split()) for r in rows]
    for doc_id, words in texts:
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            first[w] = min(first.get(w, order(doc_id)), order(doc_id))
    out = []
    for doc_id, words in texts:
        gone, own = [False] * len(words), set()
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            if w in own or first[w] < order(doc_id):
                gone[k : k + window] = [True] * window
            own.add(w)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((str(doc_id), len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(spark, rows, **sizes):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.removed(docs_of(spark, rows), **sizes).collect())


def passages():
    rng = np.random.default_rng(2)
    shared = [prose(int(n), 50 + k) for k, n in enumerate(rng.integers(18, 60, 6))]
    rows = []
    for k in range(60):
        own = prose(int(rng.integers(0, 80)), 1000 + k).split()
        for p in rng.integers(0, 6, int(rng.integers(0, 3))):
            at = int(rng.integers(0, len(own) + 1))
            own[at:at] = shared[p].split()[int(rng.integers(0, 3)) :]
        rows.append((200 + k, " ".join(own), "en", "a"))
    rows += [(300, "x " * 45, "en", "a"), (301, "x " * 30, "en", "a"), (302, "y x " * 30, "en", "a"), (303, "x y " * 25, "en", "a")]
    return HARD + rows


@pytest.mark.parametrize("n_cells", [1 << 22, 64])
def test_removed_words(spark, n_cells):
    """With few cells nearly every window passes the prefilter, with the same result."""
    assert got(spark, passages(), n_cells=n_cells) == brute(passages(), 20)


@pytest.mark.parametrize("most", [8, 1 << 10])
def test_a_full_sketch_loses_nothing(spark, monkeypatch, most):
    """More text than the sketch has room for."""
    monkeypatch.setattr(substrings, "MOST_CELLS", most)
    assert got(spark, passages()) == brute(passages(), 20)


def test_cells_follow_the_texts(spark):
    """Nine cells an anchor, or more, at any size: a text of 2 MB has about 50,000 anchors."""
    docs = docs_of(spark, [(1, "word " * 400_000, "en", "a"), (2, None, "en", "a")])
    assert substrings.cells_for(docs) == 1 << 19
    assert substrings.cells_for(docs.where("doc_id = 2")) == 1 << 16


def test_other_sizes(spark):
    assert got(spark, passages(), window=6, gram=3, n_cells=1 << 20) == brute(passages(), 6)


@pytest.mark.parametrize("doc_id", [None, 900])
def test_rows_of_one_id_with_different_texts(spark, doc_id):
    """Each has its own ranges: the passage stands at different places, beyond the other's end in one of them."""
    passage = prose(40, 90)
    rows = [(800, passage, "en", "a"), (doc_id, f"{prose(300, 91)} {passage}", "en", "a"), (doc_id, f"{passage} {prose(5, 92)}", "en", "a"), (doc_id, prose(30, 93), "en", "a")]
    want = brute(rows, 20)
    assert [r[2] for r in want].count(40) == 2
    assert got(spark, rows, n_cells=1 << 20) == want


def test_empty_table_and_no_words(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None, "en", "a"), (2, " ", "en", "a")]) == brute([(1, None), (2, " ")], 20)


def test_anchors_and_hashes_follow_the_words():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    h[300:400] = h[100:200]
    a, w = substrings.anchors(h, 20, 10), substrings.rolling(h, 20, substrings._BASES[0])
    grams = substrings.rolling(h, 10, substrings._BASES[0])
    assert len(a) == len(w) == 481
    assert all(a[k] == grams[k : k + 11].min() for k in range(481))
    assert (a[300:381] == a[100:181]).all() and (w[300:381] == w[100:181]).all() and len(set(w.tolist())) == 400
