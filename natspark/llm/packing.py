"""Packing of documents into fixed windows by the online sum-of-squares rule.

Each partition packs the documents it reads, so nothing is shuffled: a text is encoded, whole windows are cut off its
front, and the rest is placed at the fill level that keeps the sum of the squared numbers of open windows per level
least (a new window is one choice). Open windows are few; when their number passes a bound, and when the partition
ends, the fullest are filled with pieces of the emptiest, and the last part goes to windows filled to a power of two,
which need no padding. The next window number of a partition starts from the partition's number.

Defined cases: a null or empty text is one end id; a null doc_id is kept as null; repeated rows are packed once each;
an empty table gives no pieces; extra columns are ignored; a text longer than a window fills several. Texts go to Python in
parts of about ``PART_CHARS`` that end before white space, which no token spans, so that a batch of rows, which the executor
and its worker hold whole, is small however long its texts are; only the ids of a document come together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natspark.llm.tokens import END_ID, blocks, encoder

WINDOW = 2048
#: Open windows of a task, which hold 8 KB of ids each at most: a bound of memory that the rule stays far below.
OPEN_WINDOWS = 8192
#: Bytes of text encoded at a time.
BLOCK_BYTES = 3 << 19
#: Characters of the parts of a text, up to the end of a word.
PART_CHARS = 1000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = [c.split()[0] for c in PIECES.split(", ")]

#: doc_id, ids before the piece in its document, ids of the piece, ids of the document
Piece = tuple[int | None, int, np.ndarray, int]


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


class SumOfSquares:
    """Open windows by fill level; ``level[h]`` counts those filled to ``h``."""

    def __init__(self, window: int = WINDOW, bound: int = OPEN_WINDOWS, first: int = 0):
        self.window, self.bound, self.next = window, bound, first
        self.level = np.zeros(window + 1, np.int64)
        self.at: list[list[list[Piece]]] = [[] for _ in range(window + 1)]
        self.open = 0
        self.rows: list[tuple] = []

    def _close(self, pieces: Iterable[Piece]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), crc32(ids), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def choose(self, size: int) -> int:
        """The level that a piece of ``size`` goes to; 0 is a new window. Ties go to the fullest window.

        Moving a window from h to h + size changes the sum by 2 (level[h + size] - level[h]) + 2, by
        1 - 2 level[h] when it fills up, and a new window changes it by 2 level[size] + 1.
        """
        top = self.window - size
        if top < 1:
            return 0
        now = self.level[1 : top + 1]
        change = 2 * (self.level[1 + size : self.window + 1] - now) + 2
        change[-1] -= 1
        change[now == 0] = np.iinfo(np.int64).max
        best = top - int(np.argmin(change[::-1]))
        return best if change[best - 1] <= 2 * self.level[size] + 1 else 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.window:
            self._close([(doc_id, start, ids[start : start + self.window], total)])
            start += self.window
        size = total - start
        if not size:
            return
        h = self.choose(size)
        pieces = self.at[h].pop() if h else []
        pieces.append((doc_id, start, ids[start:].copy(), total))
        self.level[h] -= bool(h)
        self.open += not h
        if h + size == self.window:
            self._close(pieces)
            self.open -= 1
        else:
            self.at[h + size].append(pieces)
            self.level[h + size] += 1
        if self.open > self.bound:
            self.settle(last=False)

    def settle(self, last: bool = True) -> None:
        """Fill the fullest open windows with ids of the emptiest, whose pieces alone are moved and cut; the windows that
        are filled keep what the rule has put there. What is left over is less than a window: it stays open, or goes
        to windows that are full to a power of two if this is the ``last`` call."""
        windows = [pieces for of_level in self.at for pieces in of_level]
        fills = [h for h, of_level in enumerate(self.at) for _ in of_level]
        self.level[:], self.at, self.open = 0, [[] for _ in range(self.window + 1)], 0
        low, high = 0, len(windows) - 1
        while low <= high:
            filled, missing = windows[high], self.window - fills[high]
            while missing and low < high:
                doc_id, start, ids, total = windows[low].pop()
                part, rest = ids[:missing], ids[missing:]
                filled.append((doc_id, start, part, total))
                missing -= len(part)
                if len(rest):
                    windows[low].append((doc_id, start + len(part), rest, total))
                fills[low] -= len(part)
                low += not windows[low]
            if not missing:
                self._close(filled)
            elif last:
                self._close_in_powers(filled, self.window - missing)
            else:
                self.at[self.window - missing].append(filled)
                self.level[self.window - missing] = self.open = 1
            high -= 1

    def _close_in_powers(self, pieces: list[Piece], left: int) -> None:
        """Windows full to falling powers of two, of pieces with ``left`` ids together."""
        row, size = [], 1 << (left.bit_length() - 1)
        for doc_id, start, ids, total in pieces:
            while len(ids):
                part, ids = ids[:size], ids[size:]
                row.append((doc_id, start, part, total))
                start, size, left = start + len(part), size - len(part), left - len(part)
                if not size:
                    self._close(row)
                    row, size = [], 1 << (left.bit_length() - 1) if left else 0

    def take(self) -> pa.RecordBatch | None:
        if not self.rows:
            return None
        out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*self.rows)], names=NAMES)
        self.rows = []
        return out


def parts(docs: DataFrame) -> DataFrame:
    """``doc_id, part, last``: the texts cut before white space, in order; a text of no character has one part, which is null."""
    cut = F.regexp_extract_all(F.col("text").cast("string"), F.lit(rf"(?s).{{1,{PART_CHARS}}}[^\x20\x09-\x0D]*"), F.lit(0))
    picked = docs.select(F.col("doc_id").cast("long"), cut.alias("parts"))
    placed = picked.select("doc_id", F.size("parts").alias("n"), F.posexplode_outer("parts").alias("at", "part"))
    return placed.select("doc_id", "part", F.coalesce(F.col("at") + 1 == F.col("n"), F.lit(True)).alias("last"))


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece (see :data:`PIECES`); ``tokenizer`` is a tokenizer file, by default the box's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        packer = SumOfSquares(window, first=TaskContext.get().partitionId() << 40)
        # Ids of a document's parts so far.
        held: list[np.ndarray] = []
        for batch in batches:
            for block in blocks(batch, "part", BLOCK_BYTES):
                ids, n = enc.encode(block.column("part"), end_id)
                to = np.cumsum(n)
                for doc_id, last, a, b in zip(*(block.column(c).to_pylist() for c in ("doc_id", "last")), (to - n).tolist(), to.tolist()):
                    if not last:
                        held.append(ids[a : b - 1].copy())
                    elif held:
                        packer.add(doc_id, np.concatenate([*held, ids[a:b]]))
                        held = []
                    else:
                        packer.add(doc_id, ids[a:b])
            if (out := packer.take()) is not None:
                yield out
        packer.settle()
        if (out := packer.take()) is not None:
            yield out

    return parts(docs).mapInArrow(run, PIECES)
