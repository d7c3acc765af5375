import random
from math import comb

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from natspark.llm import simhash

from .fixtures import HARD, docs_of, prose


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(keys, pairs):
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


def close(prints):
    prints = sorted(set(prints))
    values = np.array(prints, np.uint64)
    return [(p, prints[j]) for i, p in enumerate(prints) for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2) if j > i]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", [r[1] for r in HARD if r[1] is None or len(r[1]) < 5000])
def test_fingerprints(text):
    data = None if text is None else text.encode()
    assert simhash.fingerprint(data) == plain_fingerprint(text)


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "_PIECE", 7)
    assert simhash.fingerprint(prose(100, 4).encode()) == plain_fingerprint(prose(100, 4))


@pytest.mark.parametrize("long", [64, 8, 2])
def test_links_join_what_brute_force_joins(spark, monkeypatch, long):
    """Clusters, chains and a dense ball, with posting lists paired up and met."""
    monkeypatch.setattr(simhash, "LONG", long)
    rng = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(20):
        at = rng.getrandbits(64)
        for _ in range(12):
            prints.add(at)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 3))))
    centre = rng.getrandbits(64)
    prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(16) for b in range(a)}
    df = spark.createDataFrame([(signed(p),) for p in prints], "print long")
    got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(df).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in got)
    assert union(prints, got) == union(prints, close(prints))
    if long == 64:
        few = {p for p in prints if (p ^ centre).bit_count() > 2}
        assert {tuple(sorted(x)) for x in got if set(x) <= few} == {x for x in close(few)}


def test_keys_shared_by_six_equal_bytes(spark):
    """Two of six equal bytes share as many keys as the tally asks for, whichever bytes they are."""
    at = 0x0123456789ABCDEF
    rows = [(signed(at ^ (1 << 8 * p) ^ (1 << 8 * q + 3)), ) for p in range(8) for q in range(p)] + [(at,)]
    for size in simhash.SIZES:
        posted = simhash._postings(spark.createDataFrame(rows, "print long"), size).collect()
        keys = {}
        for r in posted:
            keys.setdefault(r["print"], set()).add((r.mask, r.bytes))
        assert all(len(k) == comb(8, size) for k in keys.values())
        assert {len(k & keys[at]) for p, k in keys.items() if p != at} == {comb(6, size)}


def test_links_take_no_distance(spark):
    """Keys and stars are made for two bits, so a larger distance would lose pairs in silence."""
    with pytest.raises(TypeError):
        simhash.links(spark.createDataFrame([(0,), (7,)], "print long"), distance=3)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(-5, 3)]
    got = {r.node: r.label for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: -5 for k in [-5, *range(41)]}, **{k: 100 for k in range(100, 140)}}


def near_rows():
    base = prose(400, 7)
    words = base.split()
    rows = [(100 + k, " ".join([*words[:k], f"new{k}", *words[k + 1 :]]), "en", "a") for k in range(0, 400, 10)]
    return [*HARD, (99, base, "en", "a"), *rows]


def test_groups(spark):
    rows = near_rows()
    prints = {signed(plain_fingerprint(r[1])) for r in rows}
    root = union({p % (1 << 64) for p in prints}, close(p % (1 << 64) for p in prints))
    least = {}
    for r in rows:
        if r[0] is not None:
            p = root[plain_fingerprint(r[1])]
            least[p] = min(least.get(p, r[0]), r[0])
    want = sorted((str(r[0]), plain_fingerprint(r[1]), least.get(root[plain_fingerprint(r[1])])) for r in rows)
    docs = docs_of(spark, rows)
    got = sorted((str(r.doc_id), r["print"] % (1 << 64), r.component_id) for r in simhash.grouped(docs).collect())
    assert got == want


def test_empty_table(spark):
    assert simhash.grouped(docs_of(spark, [])).count() == 0
