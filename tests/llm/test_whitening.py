"""Whitening against a plain numpy version, and the rows that it must bear."""

import math

import numpy as np
import pytest

from natspark.llm import whitening
from natspark.llm.queries import op11_whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x int, n string, `count` long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "n", 3) for i, v in rows], SCHEMA).repartition(3)


def plain(rows, weight="one"):
    """Of the rows with a usable vector: x, and the fit of its length."""
    kept = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fits = {}
    for size in {len(x) for _, x in kept} - {0}:
        xs = [x for _, x in kept if len(x) == size]
        m = np.array(sorted(set(xs)) if weight == "one" else xs, float)
        cov = np.cov(m.T, bias=True).reshape(size, size)
        values, vectors = np.linalg.eigh(cov)
        fits[size] = (len(m), m.sum(0), values[::-1], vectors[:, ::-1], cov)
    return kept, fits


def held_to(got, rows, weight="one"):
    kept, fits = plain(rows, weight)
    assert sorted((r.vec_id or -1, r.component) for r in got) == sorted((i or -1, k + 1) for i, x in kept for k in range(min(4, len(x))))
    of = {}
    for i, x in kept:
        of.setdefault(i, []).append(x)
    signs = {}
    for r in got:
        x = next(x for x in of[r.vec_id] if len(x) >= r.component)
        n, sums, values, vectors, _ = fits[len(x)]
        k = r.component - 1
        assert r.n == n
        if len(of[r.vec_id]) == 1:
            assert r.deviation == sum((n * v - int(s)) ** 2 for v, s in zip(x, sums))
            want = float((np.array(x) - sums / n) @ vectors[:, k] / math.sqrt(values[k]))
            sign = signs.setdefault((len(x), k), math.copysign(1, want * r.whitened) if abs(want) > 1e-6 else None)
            assert r.whitened == pytest.approx((sign or 1) * want, rel=1e-6, abs=1e-6)
            if sign is None:
                del signs[len(x), k]
        assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-8


def some(n, size, seed):
    rng = np.random.default_rng(seed)
    spread = rng.normal(size=(size, size)) * np.linspace(3, 0.2, size)
    return [[float(np.float32(c)) for c in v] for v in rng.normal(size=(n, size)) @ spread]


@pytest.mark.parametrize("weight", ["one", "count"])
def test_matches_numpy(spark, weight):
    vectors = some(300, 6, 1)
    rows = list(enumerate(vectors)) + [(1000 + k, vectors[0]) for k in range(150)] + [(2000, [-0.0] * 6), (2001, [0.0] * 6)]
    held_to(whitening.whiten(table(spark, rows), weight=weight).collect(), rows, weight)


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = list(enumerate(some(50, 5, 2))) + list(enumerate(some(40, 3, 3), 100))
    bad = [(200, None), (201, [1.0, None, 2.0, 3.0, 4.0]), (202, [nan] * 5), (203, [inf, 0.0, 0.0, 0.0, 0.0]), (204, []), (205, [-inf] * 3)]
    rows += [(None, rows[0][1]), (None, rows[1][1]), (3, rows[2][1])]
    held_to(whitening.whiten(table(spark, rows + bad)).collect(), rows)


def test_without_variance(spark):
    got = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.whitened, r.explained, r.identity_error, r.deviation, r.n) for r in got] == [(None, None, None, 0, 1)] * 4
    line = [(k, [float(k), 0.0, float(k)]) for k in range(9)]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(table(spark, line)).collect()}
    assert got[4, 1].whitened == pytest.approx(0) and got[0, 2].whitened is None and got[0, 1].explained == pytest.approx(1) and got[0, 1].identity_error < 1e-9


def test_large_entries(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0]), (4, [5.0e12, 3.0])]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(table(spark, rows)).collect()}
    assert len(got) == 8 and all(r.deviation is None for (i, _), r in got.items() if i < 3)


def test_empty(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None)])).collect() == []


def test_query(spark):
    got = op11_whitening(spark, "/root/testdata/sf0.001").collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    held_to(got, rows)
