"""Substring dedup: repeated word windows, found with a count-min prefilter and grouped exactly.

A window is a run of words. Each window has an anchor, the least hash of the ten-word grams inside it, which it shares
with every equal window; neighbouring windows mostly share theirs, so a text is a short list of runs of windows.

First pass: each partition sketches the anchors of its texts, and the sketches are merged cell by cell; a cell counts, up
to two, the texts that fall into it. All rows of the sketch overestimate, so no repeated window is lost. Second pass: runs
whose anchor is estimated to be in two texts are grouped exactly. Whole runs go first, by their anchor and a hash of all
their words, 128 bits: a run that an earlier text has too is repeated window by window, which settles all but the edges
of copied passages. Only the windows of anchors that have different runs are then grouped one by one, in a third pass,
by 128 bits. Both halves come from word hashes of their own. Repeats inside one text are found where the text is read;
texts without others move no further.

The sketch has a cell in each row for every four bytes of text, about nine for each anchor, up to a fixed number that bounds
what is broadcast. Beyond it, the sketch fills up and lets more runs through, at last all of them; runs are grouped exactly
in any case, so the result is the same, and each run moves once.

A window is removed if an equal one starts earlier, in a smaller doc_id or before it in the same text. Defined cases:
null text has no words; rows with one doc_id do not precede each other, and rows without doc_id come last; rows with one
doc_id, or none, are told apart by a hash of their text, as equal texts have equal ranges; texts shorter than a window
stay; a very long text is read whole, alone in its block; an empty table gives an empty result; extra columns are ignored by :func:`removed`.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natspark.llm.common import stored
from natspark.llm.tokens import blocks

WINDOW, GRAM = 20, 10
#: Text for each cell of a row of the sketch, and rows. Cells travel in slices.
BYTES_PER_CELL, ROWS, SLICE = 4, 2, 1 << 19
#: Cells of a row at most: two rows of bits are 32 MB.
MOST_CELLS = 1 << 27
#: Multipliers of the two rolling hashes, both odd and so with inverses modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ x >> np.uint64(33)) * _MIX
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every word, in two rows, and the number of words of each text."""
    from xxhash import xxh64_intdigest

    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, n = lists.flatten(), np.diff(lists.offsets.to_numpy()).astype(np.int64)
    empty = np.flatnonzero(pc.equal(words, "").to_numpy(zero_copy_only=False))
    if len(empty):
        n -= np.bincount(np.searchsorted(lists.offsets.to_numpy(), empty, "right") - 1, minlength=len(n))
        words = words.filter(pc.not_equal(words, ""))
    coded = words.dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.array([[xxh64_intdigest(w, seed) for w in distinct] for seed in (0, 1)], np.uint64)
    return hashes[:, coded.indices.to_numpy()] if len(coded) else np.empty((2, 0), np.uint64), n


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


def _summed(h: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``h[k] base**k`` up to each word, and the inverse powers that bring their differences to one power."""
    room = 1 << max(16, len(h).bit_length())
    return np.concatenate([[np.uint64(0)], np.cumsum(h * _powers(base, room)[: len(h)])]), _powers(pow(base, -1, 1 << 64), room)


def rolling(h: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    if len(h) < size:
        return np.empty(0, np.uint64)
    sums, back = _summed(h, base)
    return mixed((sums[size:] - sums[:-size]) * back[: len(h) - size + 1])


def anchors(h: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The anchor of every window."""
    low = rolling(h, gram, _BASES[0])
    width, have = window - gram + 1, 1
    while have < width and len(low):  # doubling: low[i] is the least of so many grams from i on
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low


class Runs:
    """The runs of windows of the texts of a block: ``text``, ``start`` (in the block's words), ``size`` and ``anchor``
    of each. A run has one anchor and at most as many windows as grams in a window."""

    def __init__(self, block: pa.RecordBatch, window: int, gram: int):
        self.h, self.n = word_hashes(block.column("text"))
        self.stop = np.cumsum(self.n)
        self.begin = self.stop - self.n
        anchor = anchors(self.h[0], window, gram)
        of = np.repeat(np.arange(len(self.n)), self.n)[: len(anchor)]
        valid = np.arange(len(anchor)) + window <= self.stop[of]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])
        head = np.flatnonzero(new & valid)
        ends = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True)[: len(anchor)]) + 1 if len(anchor) else head
        size, most = ends - head, window - gram + 1
        if len(size) and size.max() > most:  # a text that repeats itself
            parts = -(-size // most)
            within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            size = np.minimum(np.repeat(size, parts) - within * most, most)
            head = np.repeat(head, parts) + within * most
        self.text, self.start, self.size, self.anchor = of[head], head, size, anchor[head]

    def spans(self, chosen: np.ndarray, window: int) -> np.ndarray:
        """Hashes of all words of the chosen runs, and of their number."""
        sums, back = _summed(self.h[1], _BASES[1])
        a, words = self.start[chosen], self.size[chosen] + window - 1
        return mixed(mixed((sums[a + words] - sums[a]) * back[a]) + words.astype(np.uint64))


def cells(anchor: np.ndarray, row: int, n_cells: int) -> np.ndarray:
    salt = np.uint64((row + 1) * _BASES[1] % (1 << 64))
    return (mixed(anchor + salt) & np.uint64(n_cells - 1)).astype(np.int64)


def hit(bits: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Which anchors are set in all rows of a bit set."""
    found = np.ones(len(anchor), bool)
    for row in range(len(bits)):
        cell = cells(anchor, row, bits.shape[1] * 8)
        found &= bits[row][cell >> 3] >> (cell & 7).astype(np.uint8) & 1 > 0
    return found


def _slices(anchor: np.ndarray, n_cells: int, rows: int) -> Iterator[pa.RecordBatch]:
    """The cells of these anchors by slice, and which of them are hit twice."""
    width = min(SLICE, n_cells)
    for row in range(rows):
        place, count = np.unique(cells(anchor, row, n_cells), return_counts=True)
        cut = np.searchsorted(place, np.arange(0, n_cells + 1, width)).tolist()
        out = [(row * (n_cells // width) + k, (place[a:b] - k * width).astype(np.uint32).tobytes(), np.packbits(count[a:b] > 1).tobytes()) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if a < b]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary()))], names=["slice", "cells", "twice"])


_PART = "slice int, cells binary, twice binary"


def _counts(sent: Iterator[pa.RecordBatch], width: int) -> np.ndarray:
    """How often the cells of a slice are hit, up to two."""
    count = np.zeros(width, np.uint8)
    for part in sent:
        for place, twice in zip(part.column("cells").to_pylist(), part.column("twice").to_pylist()):
            place = np.frombuffer(place, np.uint32)
            count[place] = np.minimum(count[place] + 1 + np.unpackbits(np.frombuffer(twice, np.uint8))[: len(place)], 2)
    return count


def merged(parts: DataFrame, n_cells: int, rows: int, least: int) -> np.ndarray:
    """The bit set of the cells that all partitions together hit ``least`` times; slices are merged in parallel."""
    width = min(SLICE, n_cells)

    def one(key: tuple, sent: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.packbits(_counts(sent, width) >= least, bitorder="little").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([bits])], names=["slice", "bits"])

    flat = np.zeros(rows * n_cells // 8, np.uint8)
    for row in parts.groupBy("slice").applyInArrow(one, "slice int, bits binary").collect():
        flat[row["slice"] * width // 8 :][: width // 8] = np.frombuffer(row["bits"], np.uint8)
    return flat.reshape(rows, -1)


def sketch(docs: DataFrame, window: int, gram: int, n_cells: int, rows: int) -> DataFrame:
    """The partitions' sketches of the anchors of each text. Merged, a cell counts two where two texts, or two anchors,
    share it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        for batch in batches:
            for block in blocks(batch, "text"):
                runs = Runs(block, window, gram)
                order = np.lexsort((runs.anchor, runs.text))
                text, anchor = runs.text[order], runs.anchor[order]
                first = np.ones(len(order), bool)
                first[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
                held.append(anchor[first])
                n_held += len(held[-1])
                if n_held > 2_000_000:
                    yield from _slices(np.concatenate(held), n_cells, rows)
                    held, n_held = [], 0
        if held:
            yield from _slices(np.concatenate(held), n_cells, rows)

    return docs.mapInArrow(run, _PART)


#: What tells rows apart.
ROW = ["doc_id", "text_a", "text_b"]
_ROW_SCHEMA = "doc_id long, text_a long, text_b long"


def row_keys(rows: pa.RecordBatch) -> list[pa.Array]:
    """The columns ``ROW`` of these rows: doc_id and a hash of the text, of 64 bits beside a doc_id and of 128 bits
    without one, as any number of rows may have none."""
    from xxhash import xxh3_128_intdigest

    digests = [xxh3_128_intdigest(t.as_buffer() if t.is_valid else b"") for t in rows.column("text")]
    low = np.fromiter((d & (1 << 64) - 1 for d in digests), np.uint64, len(digests))
    high = np.fromiter((d >> 64 for d in digests), np.uint64, len(digests))
    high[rows.column("doc_id").is_valid().to_numpy(zero_copy_only=False)] = 0
    return [rows.column("doc_id"), pa.array(low.view(np.int64)), pa.array(high.view(np.int64))]


def runs_of(docs: DataFrame, seen: Broadcast, window: int, gram: int) -> DataFrame:
    """``ROW`` and ``start, size, anchor, span`` of the runs whose anchor is estimated to be in another text too; anchor and
    span are the hash of all the run's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                runs = Runs(block, window, gram)
                chosen = np.flatnonzero(hit(seen.value, runs.anchor))
                if len(chosen):
                    text = runs.text[chosen]
                    start = (runs.start[chosen] - runs.begin[text]).astype(np.int32)
                    own = [start, runs.size[chosen].astype(np.int32), runs.anchor[chosen].view(np.int64), runs.spans(chosen, window).view(np.int64)]
                    columns = [*(c.take(pa.array(text)) for c in row_keys(block)), *map(pa.array, own)]
                    yield pa.RecordBatch.from_arrays(columns, names=[*ROW, "start", "size", "anchor", "span"])

    return docs.mapInArrow(run, f"{_ROW_SCHEMA}, start int, size int, anchor long, span long")


_WINDOWS = f"{_ROW_SCHEMA}, start int, a long, b long"


def _windows(h: np.ndarray, begin: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray, keys: list[pa.Array], window: int) -> pa.RecordBatch:
    """The windows of runs (text, start in the block's words, size) of a block; (a, b) is a window's hash."""
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    text = np.repeat(text, size)
    numbers = [rolling(h[k], window, _BASES[k])[at].view(np.int64) for k in (0, 1)]
    columns = [*(c.take(pa.array(text)) for c in keys), *map(pa.array, ((at - begin[text]).astype(np.int32), *numbers))]
    return pa.RecordBatch.from_arrays(columns, names=[*ROW, "start", "a", "b"])


def windows_of(docs: DataFrame, seen: Broadcast, several: Broadcast, window: int, gram: int) -> DataFrame:
    """``ROW`` and ``start, a, b``: the windows of the runs whose anchor has several spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                runs = Runs(block, window, gram)
                chosen = np.flatnonzero(hit(seen.value, runs.anchor))
                chosen = chosen[hit(several.value, runs.anchor[chosen])]
                if len(chosen):
                    yield _windows(runs.h, runs.begin, runs.text[chosen], runs.start[chosen], runs.size[chosen], row_keys(block), window)

    return docs.mapInArrow(run, _WINDOWS)


def _keyed(docs: DataFrame, wanted: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """``ROW`` and ``text`` of the rows that are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(wanted(batch))
            yield pa.RecordBatch.from_arrays([*row_keys(batch), batch.column("text")], names=[*ROW, "text"])

    return docs.mapInArrow(run, f"{_ROW_SCHEMA}, text string")


def _joined(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Keyed texts with the ``starts`` and ``sizes`` of their row."""
    named = lists.select(*(F.col(c).alias(f"of_{c}") for c in ROW), "starts", "sizes")
    return texts.join(named, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ROW], how).select(*ROW, "text", "starts", "sizes")


def bits_of(numbers: DataFrame, n_cells: int) -> np.ndarray:
    """A bit set of the numbers of the only column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _slices(batch.column(0).drop_null().to_numpy().view(np.uint64), n_cells, 1)

    return merged(numbers.mapInArrow(run, _PART), n_cells, 1, 1)


def cells_for(docs: DataFrame) -> int:
    """Cells of a row of the sketch of these texts: the power of two above a cell for every four bytes, up to
    ``MOST_CELLS``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max(1 << 16, 1 << (size // BYTES_PER_CELL).bit_length()), MOST_CELLS)


def earlier(docs: DataFrame, window: int, gram: int, n_cells: int | None, rows: int) -> DataFrame:
    """``ROW`` and ``ranges``: runs of windows (start, size) of a text that a text with a smaller doc_id has too. All joins
    are between stored tables, so that a run in a large share of all texts is split between tasks."""
    share = docs.sparkSession.sparkContext.broadcast
    n_cells = n_cells or cells_for(docs)
    seen = share(merged(sketch(docs, window, gram, n_cells, rows), n_cells, rows, 2))
    runs = stored(runs_of(docs, seen, window, gram), "runs")
    spans = runs.groupBy("anchor", "span").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    spans = stored(spans, "spans")
    several = spans.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    windows = stored(windows_of(docs, seen, share(bits_of(several, n_cells)), window, gram), "windows")
    firsts = windows.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b", "first")
    later = "first < doc_id or (doc_id is null and first is not null)"
    whole = runs.join(spans.where("n > 1").select("anchor", "span", "first"), ["anchor", "span"]).where(later)
    alone = windows.join(stored(firsts, "first-windows"), ["a", "b"]).where(later)
    ranges = whole.select(*ROW, "start", "size").unionByName(alone.select(*ROW, "start", F.lit(1).alias("size")))
    return ranges.groupBy(*ROW).agg(F.collect_set(F.struct("start", "size")).alias("ranges"))


def covered(h: np.ndarray, starts: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """Which words fall into a window that is repeated: those of the ranges of windows, and those that this text
    itself has before."""
    n = h.shape[1] - window + 1
    if n < 1:
        return np.zeros(h.shape[1], bool)
    edge = np.zeros(h.shape[1] + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + sizes + window - 1, -1)
    a = rolling(h[0], window, _BASES[0])
    ordered = np.sort(a)
    if (ordered[1:] == ordered[:-1]).any():
        b = rolling(h[1], window, _BASES[1])
        _, first, kind = np.unique(a, return_index=True, return_inverse=True)
        again = np.flatnonzero((np.arange(n) != first[kind]) & (b == b[first[kind]]))
        np.add.at(edge, again, 1)
        np.add.at(edge, again + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _kept(block: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """The rows of a block (``doc_id, text, starts, sizes``) with what stays of them."""
    h, n = word_hashes(block.column("text"))
    stops = np.cumsum(n).tolist()
    numbers = [pc.fill_null(block.column(c), pa.scalar([], block.column(c).type)) for c in ("starts", "sizes")]
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(numbers[0]).to_numpy())]).tolist()
    starts, sizes = (x.flatten().to_numpy().astype(np.int64) for x in numbers)
    out = []
    for k, (doc_id, text) in enumerate(zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist())):
        own, part = h[:, stops[k] - int(n[k]) : stops[k]], slice(offsets[k], offsets[k + 1])
        gone = covered(own, starts[part], sizes[part], window)
        kept = (text or "").encode().split()
        if gone.any():
            kept = [w for w, g in zip(kept, gone.tolist()) if not g]
        text = b" ".join(kept)
        out.append((doc_id, own.shape[1], int(gone.sum()), hashlib.sha256(text).hexdigest(), text))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_RESULT)


_RESULT = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
_RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def removed(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, n_cells: int | None = None, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text`` of every row. Only texts that share a window with an
    earlier one, by a bit set of their ids, are moved to meet their ranges; ``n_cells`` follows the input by default."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(earlier(texts, window, gram, n_cells, rows), "earlier")
    some = docs.sparkSession.sparkContext.broadcast(bits_of(found.select("doc_id"), n_cells or cells_for(texts)))

    def shares(batch: pa.RecordBatch) -> pa.Array:
        ids = pc.fill_null(batch.column("doc_id"), 0).to_numpy().view(np.uint64)
        return pc.or_(pa.array(hit(some.value, ids)), pc.is_null(batch.column("doc_id")))

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.filter(pc.invert(shares(batch)))
            none = pa.nulls(len(rest), pa.list_(pa.int32()))
            for block in blocks(pa.RecordBatch.from_arrays([*rest.columns, none, none], names=["doc_id", "text", "starts", "sizes"]), "text"):
                yield _kept(block, window)

    def with_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                yield _kept(block, window)

    ranges = found.select(*ROW, F.col("ranges.start").alias("starts"), F.col("ranges.size").alias("sizes"))
    joined = _joined(_keyed(texts, shares), ranges, "left")
    met = joined.select("doc_id", "text", "starts", "sizes").mapInArrow(with_ranges, _RESULT_SCHEMA)
    return texts.mapInArrow(at_once, _RESULT_SCHEMA).unionByName(met)


#: Plain windows, for doc_ids that are unique.
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place, len(w) AS n FROM d),
windows AS (SELECT doc_id, place, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS text FROM words),
ranked AS (SELECT doc_id, place, row_number() OVER (PARTITION BY text ORDER BY doc_id, place) AS rank FROM windows WHERE place + 19 <= n),
gone AS (SELECT DISTINCT doc_id, place + k AS place FROM ranked, range(20) AS t(k) WHERE rank > 1),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
