import random
import zlib

import numpy as np
import pytest

from natspark.llm import packing
from natspark.llm.tokens import WordEncoder, blocks, encoder

from .fixtures import HARD, docs_of, prose

import pyarrow as pa


def check(rows, want, window=packing.WINDOW):
    """Every id lies in one piece, windows have no gap, and only windows full to a power of two aren't full."""
    by_window, by_doc = {}, {}
    for r in rows:
        by_window.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for pieces in by_window.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for r in pieces:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window and (at == window or at & (at - 1) == 0)
    assert sum(r.length for r in rows) == sum(map(len, want.values()))
    for key, ids in want.items():
        pieces = sorted(by_doc[(key, len(ids))], key=lambda r: r.start)
        at = 0
        for r in pieces:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)


def ids_of(text):
    return [*encoder().tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("parts", [1, 7])
def test_hard_rows(spark, parts):
    rows = [r for r in HARD if r[0] is not None and r[0] != 12] + [(12, HARD[11][1], "en", "a")]
    got = packing.pack(docs_of(spark, rows).repartition(parts)).collect()
    check(got, {r[0]: ids_of(r[1]) for r in rows})


def test_repeated_rows_and_missing_ids(spark):
    got = packing.pack(docs_of(spark, [r for r in HARD if r[0] in (None, 12)])).collect()
    assert sorted(str(r.doc_id) for r in got if r.start == 0) == ["12", "12", "None"]


def test_empty_table(spark):
    assert packing.pack(docs_of(spark, [])).collect() == []


def brute_choice(level, size, window):
    """The level whose choice makes the sum of squares least, tried one by one; the fullest of equals."""
    def after(h):
        n = level.copy()
        if h:
            n[h] -= 1
        if h + size < window:
            n[h + size] += 1
        return sum(int(x) ** 2 for x in n[1:window])

    options = [0, *(h for h in range(1, window - size + 1) if level[h])]
    return min(options, key=lambda h: (after(h), -h))


def test_levels_are_chosen_as_by_trial():
    rng = np.random.default_rng(0)
    packer = packing.SumOfSquares(32, bound=1000)
    for k in range(3000):
        size = int(rng.integers(1, 32))
        want = brute_choice(packer.level, size, 32)
        assert packer.choose(size) == want
        packer.add(k, np.arange(size, dtype=np.uint32))
        assert packer.open == packer.level[1:32].sum()


def test_few_open_windows_and_little_padding():
    rng = np.random.default_rng(1)
    packer = packing.SumOfSquares(64, bound=16)
    docs = {k: np.arange(int(n), dtype=np.uint32) for k, n in enumerate(rng.integers(1, 200, 2000))}
    for k, ids in docs.items():
        packer.add(k, ids)
        assert packer.open <= 17
    packer.settle()
    fill = {}
    for r in packer.rows:
        fill[r[5]] = fill.get(r[5], 0) + r[2]
    assert sum(fill.values()) == sum(map(len, docs.values()))
    assert all(f == 64 or f & (f - 1) == 0 for f in fill.values()) and sum(f < 64 for f in fill.values()) <= 6


def test_the_bound_is_far_from_what_the_rule_leaves_open():
    """100,000 documents of very uneven sizes: at most a few hundred windows are open at a time, and at the end few pieces
    are cut."""
    rng = np.random.default_rng(2)
    packer, most = packing.SumOfSquares(), 0
    for k, n in enumerate(np.minimum(rng.pareto(1.1, 100_000) * 60 + 1, 20_000).astype(int)):
        packer.add(k, np.zeros(n, np.uint32))
        most = max(most, packer.open)
    assert most < packing.OPEN_WINDOWS / 8
    placed = len(packer.rows)
    packer.settle()
    assert len(packer.rows) - placed < 0.02 * len(packer.rows)


def test_filled_windows_keep_what_the_rule_has_placed():
    """At the end of a small task: windows that are filled up begin with their pieces as they were, only pieces of the
    emptiest windows move, and fewer than half of all do."""
    rng = np.random.default_rng(3)
    packer = packing.SumOfSquares()
    for k, n in enumerate(np.minimum(rng.pareto(1.1, 1000) * 200 + 1, 20_000).astype(int)):
        packer.add(k, np.full(n, k, np.uint32))
    before = [(h, [(d, s, len(i)) for d, s, i, _ in pieces]) for h, of in enumerate(packer.at) for pieces in of]
    placed = len(packer.rows)
    ids = sum(r[2] for r in packer.rows) + sum(h for h, _ in before)
    packer.settle()
    after = {}
    for r in packer.rows[placed:]:
        after.setdefault(r[5], []).append((r[0], r[1], r[2]))
    heads = {tuple(pieces[0]): pieces for pieces in after.values()}
    kept = [pieces for _, pieces in before if heads.get(pieces[0], [])[: len(pieces)] == pieces]
    assert len(kept) >= len(after) - 12 and sum(r[2] for r in packer.rows) == ids
    moved = sum(len(p) for _, p in before) - sum(map(len, kept))
    assert moved < 0.5 * len(packer.rows)


def test_words_encode_as_whole_texts():
    texts = [r[1] for r in HARD] + ["a\x1cb\x85c d", "İ I i̇", "x" * 5000, "<|endoftext|> <|end of text|>", "é ́e", "1,2.3!? ... .,", "'s'S'll", prose(2000, 9)]
    ids, n = encoder().encode(pa.array(texts, pa.string()))
    at = 0
    for text, k in zip(texts, n.tolist()):
        assert ids[at : at + k].tolist() == ids_of(text)
        at += k


def test_words_with_signs_encode_as_whole_texts():
    rng = random.Random(4)
    odd = ["İ.", "×,", "÷.", "ß..", "Ⱥ!", "ɐ.", "a.'", "'LL.", "x" + "!" * 20, "≠", "a≠.", "ñ$$$", "<|", "|>", "<|endoftext|>.", "<|ENDOFTEXT|>"]
    letters = [*"abAB.,;:!?'\"-1 2\n\té́ŒΣς你Жж", " ", " ", *odd]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    plain = [t.replace("<|", "") for t in texts]
    enc = WordEncoder(encoder().path, remembered=100)
    for part in (texts, plain, plain[::-1]):
        ids, n = enc.encode(pa.array(["", *part], pa.string()).slice(1))
        want = [[*e.ids, 1] for e in enc.tokenizer.encode_batch(part, add_special_tokens=False)]
        assert n.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
        assert len(enc.index) > 1 and enc.index[""] == 0


def test_blocks_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * k for k in (5, 0, 50, 3, 3)] + [None]})
    assert [len(b) for b in blocks(batch, "text", 8)] == [2, 1, 3]


@pytest.mark.parametrize("chars", [1, 40])
def test_texts_go_in_parts(spark, monkeypatch, chars):
    """A batch for Python is bounded by its rows: no part is longer than a few words more than it should, and the ids are
    those of whole texts."""
    monkeypatch.setattr(packing, "PART_CHARS", chars)
    made = [(100 + k, prose(3 * k, k), "en", "a") for k in range(30)] + [(200, " ", "en", "a"), (201, " a\n ", "en", "a"), (202, "é\u2003ö 你好\x0bx" * 20, "en", "a")]
    rows = [r for r in HARD if r[0] is not None and r[0] != 12] + made
    docs = docs_of(spark, rows).repartition(3)
    cut = packing.parts(docs).collect()
    assert sum(r.last for r in cut) == len(rows) and sum(len(r.part or "") for r in cut) == sum(len(r[1] or "") for r in rows)
    assert all(len(r.part) <= chars + 20 for r in cut if r.doc_id >= 100 and r.part)
    check(packing.pack(docs).collect(), {r[0]: ids_of(r[1]) for r in rows})


def test_memory_goes_back_after_each_block(monkeypatch):
    given = []
    monkeypatch.setattr("natspark.llm.tokens._give_back", lambda: given.append(1))
    batch = pa.RecordBatch.from_pydict({"text": ["a" * k for k in (5, 0, 50, 3, 3)]})
    for k, _ in enumerate(blocks(batch, "text", 8)):
        assert len(given) == k
    assert len(given) == 3


def test_the_model_is_held_once():
    """A second copy of its entries took 16 MB of each worker."""
    enc = WordEncoder(encoder().path)
    enc.tokenizer.model.end_of_word_suffix = "?"
    assert enc.plain.model.end_of_word_suffix == "?"
