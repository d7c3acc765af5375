"""Embedding whitening: equal vectors are grouped and counted, a weighted covariance is fitted to the distinct ones, each
distinct vector is whitened once, and rows get its result back by a join.

Vectors are numbers in fixed point: ``x = floor(scale * c)`` for each entry ``c`` as double, so that equality, sums and
deviations are exact. The fit weighs each distinct vector by its count or by one (``weight``). A first pass sums the
entries, with high and low halves apart, so that no sum of whole numbers is rounded; the second centres each distinct
vector by the exact mean and adds up a matrix product for each task, of which Spark sums the cells. Only that matrix,
of dimension squared, reaches the driver: its size doesn't follow the rows.

Defined cases: rows whose vector is null, or holds null or non-finite entries, are dropped. Vectors of another length
are fitted apart, each length with its own mean and covariance. Empty vectors have no components and give no rows. Entries beyond a long take its nearest end. A component without variance
(an eigenvalue of at most 1e-12 of the trace) isn't whitened: ``whitened`` is null, as ``explained`` is if the trace is
zero; such components stay out of ``identity_error``, which is then null if none is left. ``deviation`` is null where it
doesn't fit a long. Rows of one id or none are rows of their own. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natspark.llm.common import stored

SCALE = 256
COMPONENTS = 4
#: Of the trace: less is rounding, not variance.
LEAST_SHARE = 1e-12
_TOP = np.nextafter(2.0**63, 0)
_CHUNK = 8192


@dataclass(frozen=True)
class Fit:
    """The fit of the vectors of one length: weights and weighted sums as whole numbers, eigenvalues and vectors falling."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])

    @property
    def trace(self) -> float:
        return float(self.values.sum())

    @property
    def scales(self) -> np.ndarray:
        """Of each component 1 / sqrt(eigenvalue), or nan where there is no variance."""
        usable = self.values > LEAST_SHARE * self.trace
        return np.where(usable, 1 / np.sqrt(np.where(usable, self.values, 1)), np.nan)


def _matrix(column: pa.Array, kind: type) -> list[tuple[np.ndarray, np.ndarray]]:
    """The lists of each length as a matrix, with the places of its rows, in pieces of bounded size."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = []
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        for begin in range(0, len(rows), _CHUNK):
            at = rows[begin : begin + _CHUNK]
            out.append((at, column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, size)))
    return out


def fixed_point(vectors: DataFrame, id_column: str, vector_column: str, scale: int = SCALE) -> DataFrame:
    """``id, x``: each usable row's vector in whole numbers."""
    entries = F.col("entries")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    # A null test gives null or a value, so only a list without any is kept.
    usable = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("entries")).where(~F.coalesce(bad, F.lit(True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            with np.errstate(over="ignore"):
                flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale)
            x = np.clip(flat, -(2.0**63), _TOP).astype(np.int64)
            x[flat >= 2.0**63] = np.iinfo(np.int64).max
            offsets = pa.array(np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(x))], names=["id", "x"])

    kind = usable.schema["id"].dataType.simpleString()
    return usable.mapInArrow(run, f"id {kind}, x array<bigint>")


def _sums(distinct: DataFrame, weight: str) -> dict[int, tuple[int, list[int]]]:
    """Of each length the sum of weights and the exact weighted sum of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for at, x in _matrix(batch.column("x"), np.int64):
                w = weights[at]
                held = total.setdefault(x.shape[1], [0, [0] * x.shape[1]])
                held[0] += int(w.sum())
                # Halves of 32 bits add up within a long up to this weight; beyond it, in Python's own numbers.
                if int(w.sum()) < 1 << 31:
                    low, high = ((x & 0xFFFFFFFF).T @ w).tolist(), ((x >> 32).T @ w).tolist()
                else:
                    low, high = ((x & 0xFFFFFFFF).astype(object).T @ w.astype(object)).tolist(), ((x >> 32).astype(object).T @ w.astype(object)).tolist()
                held[1] = [s + (h << 32) + lo for s, h, lo in zip(held[1], high, low)]
        rows = [(size, k, str(n), str(s)) for size, (n, sums) in total.items() for k, s in enumerate(sums)]
        names = ["size", "k", "n", "s"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], pa.schema([("size", pa.int32()), ("k", pa.int32()), ("n", pa.string()), ("s", pa.string())]))

    exact = "decimal(38,0)"
    parts = distinct.select("x", F.col(weight).alias("weight")).mapInArrow(run, "size int, k int, n string, s string")
    rows = parts.groupBy("size", "k").agg(F.sum(F.col("n").cast(exact)).cast("string").alias("n"), F.sum(F.col("s").cast(exact)).cast("string").alias("s")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(rows, key=lambda r: (r.size, r.k)):
        out.setdefault(r.size, (int(r.n), []))[1].append(int(r.s))
    return out


def covariance(rows: DataFrame, column: str, weight: str, means: dict[int, np.ndarray], totals: dict[int, int]) -> dict[int, np.ndarray]:
    """The weighted covariance (divisor: the sum of weights) of the lists in ``column``, of each length apart. Vectors
    are centred by ``means`` before they are multiplied; a task keeps one matrix and Spark sums the cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for at, x in _matrix(batch.column("x"), np.float64):
                centred = x - means[x.shape[1]]
                product = (centred * weights[at][:, None]).T @ centred
                held[x.shape[1]] = held[x.shape[1]] + product if x.shape[1] in held else product
        for size, product in held.items():
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), size, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(product[i, j])], names=["size", "i", "j", "v"]
            )

    parts = rows.select(F.col(column).alias("x"), F.col(weight).cast("double").alias("weight")).mapInArrow(run, "size int, i int, j int, v double")
    out = {size: np.zeros((size, size)) for size in totals}
    for r in parts.groupBy("size", "i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.size][r.i, r.j] = out[r.size][r.j, r.i] = r.v / totals[r.size]
    return out


def fit(distinct: DataFrame, weight: str = "one") -> dict[int, Fit]:
    """A fit for each length among ``distinct`` (``x``, and the column that ``weight`` names)."""
    sums = _sums(distinct, weight)
    means = {size: np.array([float(Fraction(s, n)) for s in of]) for size, (n, of) in sums.items()}
    matrices = covariance(distinct, "x", weight, means, {size: n for size, (n, _) in sums.items()})
    fits = {}
    for size, (n, of) in sums.items():
        values, vectors = np.linalg.eigh(matrices[size])
        fits[size] = Fit(n, of, np.maximum(values[::-1], 0), np.ascontiguousarray(vectors[:, ::-1]))
    return fits


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """``sum((n x - S)^2)`` of each row, exact; null where it doesn't fit a long."""
    size = x.shape[1]
    most = max(int(x.max()), -int(x.min()), 1) * n + max(map(abs, sums), default=0)
    if most * most * size < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    totals = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [t if t < 1 << 63 else None for t in totals]


def _whiten(distinct: DataFrame, fits: dict[int, Fit], components: int) -> DataFrame:
    """``x, one, count, deviation, whitened`` (a list of up to ``components``) of each distinct vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviation: list = [None] * len(batch)
            whitened: list = [[]] * len(batch)
            for at, x in _matrix(batch.column("x"), np.int64):
                f = fits[x.shape[1]]
                k = min(components, x.shape[1])
                rows = ((x - f.mean) @ f.vectors[:, :k]) * f.scales[:k]
                for place, d, w in zip(at.tolist(), _deviations(x, f.n, f.sums), rows.tolist()):
                    deviation[place], whitened[place] = d, w
            columns = [*(batch.column(c) for c in ("x", "one", "count")), pa.array(deviation, pa.int64()), pa.array(whitened, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["x", "one", "count", "deviation", "whitened"])

    return distinct.select("x", "one", "count").mapInArrow(run, "x array<bigint>, one bigint, count bigint, deviation bigint, whitened array<double>")


def _identity_errors(whitened: DataFrame, fits: dict[int, Fit], weight: str, components: int) -> dict[int, float | None]:
    """Of each length the largest entry of the whitened vectors' covariance less the identity, over usable components."""
    size = F.size("x").alias("size")
    entries = whitened.select(size, F.col(weight).alias("w"), F.posexplode("whitened").alias("k", "v"))
    means = {s: np.zeros(min(components, s)) for s in fits}
    for r in entries.groupBy("size", "k").agg((F.sum(F.col("v") * F.col("w")) / F.sum("w")).alias("mean")).collect():
        means[r["size"]][r.k] = r.mean
    errors: dict[int, float | None] = {}
    by_length: dict[int, list[int]] = {}
    for s in fits:
        by_length.setdefault(min(components, s), []).append(s)
    for k, sizes in by_length.items():
        for s in sizes:
            got = covariance(whitened.where(F.size("x") == s), "whitened", weight, {k: means[s]}, {k: fits[s].n})[k]
            usable = ~np.isnan(fits[s].scales[:k])
            part = np.abs(got - np.eye(k))[np.ix_(usable, usable)]
            errors[s] = float(part.max()) if part.size else None
    return errors


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", weight: str = "one", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``id_column, component, n, deviation, whitened, explained, identity_error``: a row for each usable row and each of
    its first ``components``. ``weight``: ``one`` for each distinct vector once, ``count`` for each as often as it occurs."""
    rows = stored(fixed_point(vectors, id_column, vector_column, scale), "vectors")
    distinct = stored(rows.groupBy("x").agg(F.count(F.lit(1)).alias("count"), F.lit(1).cast("long").alias("one")), "distinct")
    fits = fit(distinct, weight)
    whitened = stored(_whiten(distinct, fits, components), "whitened")
    errors = _identity_errors(whitened, fits, weight, components)
    spark = vectors.sparkSession
    facts = [(size, f.n, [float(v) / f.trace if f.trace > 0 else None for v in f.values[:components]], errors[size]) for size, f in fits.items()]
    # A row for each length: as small as the fits themselves.
    of = F.broadcast(spark.createDataFrame(facts, "size int, n long, shares array<double>, identity_error double"))
    found = F.transform("whitened", lambda w, k: F.struct((k + 1).alias("component"), F.when(~F.isnan(w), w).alias("whitened"), F.get("shares", k).alias("explained")))
    results = whitened.withColumn("size", F.size("x")).join(of, "size").select("x", "n", "deviation", "identity_error", found.alias("found"))
    # Both sides are read from tables and dealt anew, so that a vector of many rows can be split.
    joined = rows.join(results.hint("shuffle_hash"), "x").select(F.col("id").alias(id_column), "n", "deviation", "identity_error", F.explode("found").alias("f"))
    return joined.select(id_column, "f.component", "n", "deviation", "f.whitened", "f.explained", "identity_error")
