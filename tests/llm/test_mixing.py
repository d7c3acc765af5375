import numpy as np
import pytest
from pyspark.sql import functions as F

from natspark.llm import mixing

from .fixtures import HARD, docs_of


def brute_targets(words):
    """``words`` by source, null last: shares by weight, capped at three times, the rest shared again until none is
    above."""
    order = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    rest, open_, target = sum(words.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if rest * weight[s] / total > 3 * words[s]}
        if not over:
            return target | {s: rest * weight[s] / total for s in open_}
        for s in over:
            target[s] = 3.0 * words[s]
        rest -= sum(3 * words[s] for s in over)
        open_ -= over
    return target


def mixed(spark, rows):
    """``rows``: (doc_id, source, size)."""
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(3)
    out = mixing.mix(df, F.col("size")).select("doc.*", "source_size", "target", "copies").collect()
    assert len(out) == len(rows)
    return out


def sources_of(seed, n=600):
    rng = np.random.default_rng(seed)
    names = ["big"] * (n // 3) + [str(x) for x in rng.choice(["a", "b", "é", "zz", "tiny"], n - n // 3, p=[0.3, 0.3, 0.2, 0.19, 0.01])]
    sizes = (np.exp(rng.normal(5, 1.3, n)) - 1).astype(int)
    return [(k, None if s == "zz" else s, int(x)) for k, (s, x) in enumerate(zip(names, sizes))] + [(n + k, "big", 20_000 + k) for k in range(3)]


@pytest.mark.parametrize("seed", range(3))
def test_targets_are_met_in_whole_copies(spark, seed):
    rows = sources_of(seed)
    words = {}
    for _, s, n in rows:
        words[s] = words.get(s, 0) + n
    want = brute_targets(words)
    got = mixed(spark, rows)
    taken = {}
    for r in got:
        assert r.source_size == words[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    for s, t in want.items():
        least = min(n for _, x, n in rows if x == s and n)
        assert abs(taken[s] - t) <= max(0.02 * t, 2 * least), (s, taken[s], t)
    assert sorted(map(str, got)) == sorted(map(str, mixed(spark, rows[::-1])))


def test_rates_are_exponential_in_size(spark):
    """The tilt is the root of the dual: numpy finds the same by bisection."""
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 4000, 3000)
    rows = [(k, "a" if k < 2000 else "b", int(n)) for k, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    taken = {r.doc.doc_id: r.copies * r["size"] for r in mixing.mix(df, F.col("size")).collect()}
    for source, part in (("a", sizes[:2000]), ("b", sizes[2000:])):
        target = brute_targets({"a": int(sizes[:2000].sum()), "b": int(sizes[2000:].sum())})[source]
        mean = part.mean()
        rate = lambda t: np.minimum(3, np.exp(np.minimum(t * part / mean, 700)))
        low, high = -100.0, 100.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if (rate(mid) * part).sum() < target else (low, mid)
        # From the largest down, the words taken follow those of the rates to within a document.
        first = 0 if source == "a" else 2000
        order = np.argsort(-part, kind="stable")
        words = np.cumsum([taken[first + int(k)] for k in order])
        same_size = np.append(np.diff(part[order]) != 0, True)
        assert np.abs(words - np.cumsum((rate(mid) * part)[order]))[same_size].max() <= 4000
        bins = F.array(*(F.struct(F.lit(int(s)).alias("bin"), F.lit(1).alias("n"), F.lit(float(s)).alias("words"), F.lit(float(s)).alias("mean")) for s in part[:300]))
        part = part[:300]
        mean, target = part.mean(), 0.6 * part.sum()
        got = spark.range(1).select(mixing._tilt(bins, F.lit(float(mean)), F.lit(float(target)), 3)).first()[0]
        assert (np.minimum(3, np.exp(got * part / mean)) * part).sum() == pytest.approx(target, rel=1e-6)


def test_one_size_and_hot_bins(spark):
    got = mixed(spark, [(k, "a", 10) for k in range(500)] + [(500 + k, "b", 10) for k in range(500)])
    taken = {s: sum(r.copies * r.size for r in got if r.source == s) for s in "ab"}
    assert abs(taken["a"] - 10_000 * 5 / 7) <= 10 and abs(taken["b"] - 10_000 * 2 / 7) <= 10


def test_hard_rows_and_other_columns(spark):
    docs = docs_of(spark, HARD)
    got = mixing.resample(docs)
    assert got.columns == docs.columns
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(HARD)
    assert all(r.copies == 0 for r in rows if not (r.doc.text or "").split())
    assert got.count() == sum(r.copies for r in rows)


def test_nothing_to_mix(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0
    rows = mixing.mix(docs_of(spark, [(1, None, "en", "a"), (2, " ", "en", None)])).collect()
    assert [(r.size, r.target, r.copies) for r in rows] == [(0, 0.0, 0)] * 2
