"""Alignment against a plain version that encodes each whole text and compares every pair of tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from natspark.llm import alignment
from natspark.llm.queries import op12_alignment

from .fixtures import HARD, docs_of

WORDS = ["the", "running", "naïve", "Straße", "don't", "12345", "x_y", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "<unk>", "中文字", "😀😀", "á", "...", "▁", "ab\ncd", "\tq", " ", "　z", "\x1c", "\x85", "﻿", "ﬁ", "Ǆ"]


def made_texts(n, seed):
    rng = random.Random(seed)
    gaps = [" "] * 12 + ["  ", "\n", " \n", "\t ", " ", "\r\n", ""]
    return ["".join(rng.choice(WORDS) + rng.choice(gaps) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def spans(ids, pieces):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(pieces[i])))
        at += len(pieces[i])
    return out


def plain(texts):
    two = alignment.tokenizers()
    links, rows = [], []
    for text in texts:
        if not text:
            links.append(Counter()), rows.append((0, 0, 0, 0, ""))
            continue
        a = spans(two.byte_level.encode(f" {text}", add_special_tokens=False).ids, two.bytes_a)
        b = spans(two.pieces.encode(text), two.bytes_b)
        want = f" {text}".encode()
        if b"".join(two.bytes_a[i] for i, *_ in a) != want or b"".join(two.bytes_b[i] for i, *_ in b) != want:
            links.append(Counter()), rows.append((0, 0, 0, 0, ""))
            continue
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in (a, b)))
            start = cut
        met = Counter((i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f))
        links.append(met), rows.append((len(a), len(b), len(cuts), sum(met.values()), ";".join(groups)))
    docs = Counter(p for met in links for p in met)
    most = defaultdict(int)
    for (i, _), n in docs.items():
        most[i] = max(most[i], n)
    return [(*r, sum(k for p, k in met.items() if docs[p] == most[p[0]]), sum(k * docs[p] for p, k in met.items())) for r, met in zip(rows, links)]


def row(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum


def test_matches_every_pair(spark, monkeypatch):
    texts = [*made_texts(120, 1), None, "", " ", "  a", "a ", "\n", "x" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: row(r) for r in alignment.align(docs).collect()}
    assert [got[k] for k in range(len(texts))] == plain(texts)


def test_blocks_and_forgetting(spark):
    """Small blocks and a small memory give what one block gives."""
    import pyarrow as pa

    texts = made_texts(60, 2)
    small = alignment.TwoTokenizers(*(__import__("public_tokenizers").path(n) for n in (alignment.BYTE_TOKENIZER, alignment.PIECE_TOKENIZER)), remembered=5)
    want = plain(texts)
    for begin in range(0, 60, 7):
        rows, _ = alignment.align_block(small, pa.array(texts[begin : begin + 7]))
        assert [tuple(r.values()) for r in rows.to_pylist()] == [w[:5] for w in want[begin : begin + 7]]


def test_hard_rows(spark):
    rows = [r for r in HARD if r[1] is None or len(r[1]) < 5000]
    got = sorted(((r.doc_id or -1), row(r)) for r in alignment.align(docs_of(spark, rows)).collect())
    assert got == sorted(zip([r[0] or -1 for r in rows], plain([r[1] for r in rows])))


def test_empty(spark):
    assert alignment.align(docs_of(spark, [])).collect() == []
    assert [row(r) for r in alignment.align(docs_of(spark, [(1, None, None, None)])).collect()] == [(0, 0, 0, 0, "", 0, 0)]


def test_query(spark, tmp_path):
    path = f"file://{tmp_path}"
    docs_of(spark, [r for r in HARD if r[0] not in (None, 12)]).write.parquet(f"{path}/documents.parquet")
    rows = {r[0]: r[1] for r in HARD if r[0] not in (None, 12)}
    got = {r.doc_id: r for r in op12_alignment(spark, path).collect()}
    whole = {r.doc_id: r for r in alignment.align(spark.read.parquet(f"{path}/documents.parquet")).collect()}
    assert set(got) == set(rows)
    for k, r in got.items():
        assert r.groups_sha256 == (hashlib.sha256(whole[k].groups.encode()).hexdigest() if whole[k].groups else "") and r.count_sum == whole[k].count_sum
    assert got[6].n_a > 30_000 and pytest.approx(got[6].n_links) == got[6].n_a + got[6].n_b - got[6].n_groups
