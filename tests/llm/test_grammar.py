import zlib
from collections import Counter

import numpy as np
import pytest

from natspark.llm import grammar
from natspark.llm.tokens import encoder

from .fixtures import HARD, docs_of


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 3000])
@pytest.mark.parametrize("kinds", [1, 2, 7, 49000])
def test_any_range_is_decoded(n, kinds):
    rng = np.random.default_rng(n + kinds)
    ids = rng.integers(0, kinds, n).astype(np.uint32)
    segment = grammar.Segment(memoryview(grammar.compress(ids)))
    assert np.array_equal(segment.read(), ids)
    for _ in range(20):
        a, b = sorted(rng.integers(0, n + 1, 2))
        assert np.array_equal(segment.read(int(a), int(b - a)), ids[a:b])


def test_repeats_become_rules():
    ids = np.tile(np.arange(40, dtype=np.uint32), 500)
    data = grammar.compress(ids)
    segment = grammar.Segment(memoryview(data))
    assert len(segment.rounds) > 1 and len(segment.symbols) < len(ids) / 4 and len(data) < 2 * len(ids)
    assert np.array_equal(segment.read(), ids)


def test_a_run_of_one_symbol_is_halved_each_round():
    data = grammar.compress(np.full(5001, 7, np.uint32))
    segment = grammar.Segment(memoryview(data))
    assert len(segment.symbols) < 40 and len(data) < 200
    assert segment.read(4990, 11).tolist() == [7] * 11


def test_rules_are_pairs_counted_exactly():
    rng = np.random.default_rng(5)
    seq = rng.integers(0, 30, 4000).astype(np.uint32)
    codes = seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:].astype(np.uint64)
    count = Counter(codes.tolist())
    found = grammar._frequent(codes).tolist()
    assert sorted(found) == sorted(c for c, n in count.items() if n >= grammar.LEAST_USES)
    assert [count[c] for c in found] == sorted((count[c] for c in found), reverse=True)


def test_grammars_are_smaller_than_plain_ids_and_zlib_of_these():
    rng = np.random.default_rng(6)
    words = [rng.integers(2, 3000, rng.integers(1, 4)) for _ in range(4000)]
    often = 1 / np.arange(1, 4001)
    ids = np.concatenate([words[w] for w in rng.choice(4000, 150_000, p=often / often.sum())]).astype(np.uint32)
    plain = ids.astype("<u2").tobytes()
    assert len(grammar.compress(ids)) < len(zlib.compress(plain, 6)) < len(plain)


def test_shards_of_many_segments(monkeypatch):
    monkeypatch.setattr(grammar, "SEGMENT_IDS", 64)
    rng = np.random.default_rng(3)
    lengths = [1, 700, 3, 64, 128, 1]
    ids = rng.integers(0, 9, sum(lengths)).astype(np.uint32)
    shard = grammar.Shard(grammar.build_shard([None, 5, 6, 7, 8, 9], lengths, ids))
    parts = np.split(ids, np.cumsum(lengths)[:-1])
    assert [d[3] for d in shard.digests()] == [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]
    assert shard.doc_ids[0] is None
    assert np.array_equal(shard.read(60, 500), ids[60:560])


def test_whole_tables(spark, tmp_path):
    path = f"file://{tmp_path}/ids"
    grammar.write_ids(docs_of(spark, HARD), path)
    rows = sorted(grammar.read_ids(spark, path).collect(), key=lambda r: r.start)
    tokenizer = encoder().tokenizer
    want = sorted(HARD, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in rows] == [r[0] for r in want]
    ids = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in want}
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        if [w[0] for w in want].count(r.doc_id) == 1:
            assert r.n_tokens == len(ids[r.doc_id])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id], "<u4").tobytes())


def test_empty_table(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    grammar.write_ids(docs_of(spark, []), path)
    assert grammar.read_ids(spark, path).count() == 0
