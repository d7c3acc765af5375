"""Token ids in a binary file format, compressed by Re-Pair grammars.

Documents are laid out in ascending doc_id order over shards of whole documents. A shard has a grammar of its own (one
for each so many ids, if a very long text makes it larger): in rounds, the most frequent pairs of neighbouring symbols,
counted exactly, become nonterminals and their occurrences are replaced, until a round saves less than a hundredth.
Rules and the number of ids each expands to are stored, so any range of ids is decoded from the symbols that cover it
alone. Symbols take as many bits as their number asks for.

A shard is one row of a Parquet table, written by Spark's committer: a lost executor costs the rerun of its tasks.
``payload`` is little-endian: ``magic, documents, segments``, then for each document ``doc_id, has id, ids``, then the
segments, each with ``ids, terminals, rules, symbols, rounds, bits per symbol, bytes per length``, the terminals, the
rules of each round, both sides of the rules, their expansion lengths and the symbols.

Defined cases: a null or empty text is one end id; null doc_ids come first; rows with the same doc_id follow each other
in the order of their texts' hashes; an empty table gives an empty file; extra columns are ignored; a text longer than
a segment spans several.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from natspark.llm.tokens import END_ID, blocks, encoder

SHARD_IDS = 1 << 20
#: The most ids of one grammar; a shard has more only if a text is that long.
SEGMENT_IDS = 1 << 21
PAIRS_PER_ROUND = 8192
#: A rule must replace so many pairs to be kept, and a round so large a share of the symbols to be followed by another.
LEAST_USES, LEAST_GAIN = 4, 0.01
MAGIC = b"NGR2"
SHARDS = "part int, shard int, n_docs long, n_ids long, payload binary"
_HEAD, _SEGMENT = struct.Struct("<4sQI"), struct.Struct("<QIIQIBB")
_BITS = 18
_MIX = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int32(2**31 - 1)


def _frequent(codes: np.ndarray) -> np.ndarray:
    """The most frequent pairs, by exact counts, in descending order."""
    ordered = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    count = np.diff(np.append(first, len(ordered)))
    often = np.flatnonzero(count >= LEAST_USES)
    if len(often) > PAIRS_PER_ROUND:
        often = often[np.argpartition(-count[often], PAIRS_PER_ROUND)[:PAIRS_PER_ROUND]]
    return ordered[first[often[np.argsort(-count[often], kind="stable")]]]


def _round(seq: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence with frequent pairs replaced by symbols from ``base`` on, and the pairs. Of overlapping occurrences
    the more frequent pair's wins, of equal ones every other from the left. Pairs are looked up in a hash table; of two
    in one place the less frequent waits for the next round."""
    codes = seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:].astype(np.uint64)
    pairs = _frequent(codes)
    place_of = lambda x: (x * _MIX >> np.uint64(64 - _BITS)).astype(np.int64)
    _, first = np.unique(place_of(pairs), return_index=True)
    pairs = pairs[np.sort(first)]
    pair, rank_of = np.zeros(1 << _BITS, np.uint64), np.full(1 << _BITS, _NONE)
    pair[place_of(pairs)], rank_of[place_of(pairs)] = pairs, np.arange(len(pairs), dtype=np.int32)
    rank = np.full(len(codes) + 2, _NONE)
    place = place_of(codes)
    rank[1:-1] = np.where(pair[place] == codes, rank_of[place], _NONE)
    same = np.flatnonzero((codes[1:] == codes[:-1]) & (rank[2:-1] < _NONE)) + 1  # inside a run of one symbol
    if len(same):
        head = np.flatnonzero(np.diff(same, prepend=-1) > 1)
        nth = same - np.repeat(same[head], np.diff(np.append(head, len(same))))
        rank[1 + same[nth % 2 == 0]] = _NONE
    at = np.flatnonzero((rank[1:-1] < rank[:-2]) & (rank[1:-1] <= rank[2:]) & (rank[1:-1] < _NONE))
    uses = np.bincount(rank[1 + at], minlength=len(pairs))
    kept = uses >= LEAST_USES
    at = at[kept[rank[1 + at]]]
    number = np.cumsum(kept) - 1 + base
    out = seq.copy()
    out[at] = number[rank[1 + at]]
    stays = np.ones(len(seq), bool)
    stays[at + 1] = False
    return out[stays], pairs[kept]


def _packed(values: np.ndarray, bits: int) -> bytes:
    """So many bits of each value: whole bytes first, a byte of all values after the other, then what is left."""
    whole = [(values >> np.uint32(8 * k)).astype(np.uint8) for k in range(bits // 8)]
    rest = values >> np.uint32(bits // 8 * 8)
    left = np.packbits((rest[:, None] >> np.arange(bits % 8, dtype=np.uint32) & np.uint32(1)).astype(np.uint8))
    return b"".join(x.tobytes() for x in (*whole, left))


def _unpacked(data: memoryview, n: int, bits: int) -> tuple[np.ndarray, int]:
    """The values, and the bytes they took."""
    out, size, over = np.zeros(n, np.uint32), bits // 8 * n, bits % 8
    for k in range(bits // 8):
        out |= np.frombuffer(data, np.uint8, n, k * n).astype(np.uint32) << np.uint32(8 * k)
    last = -(-n * over // 8)
    if last:
        left = np.unpackbits(np.frombuffer(data, np.uint8, last, size), count=n * over).reshape(n, over)
        for k in range(over):
            out |= left[:, k].astype(np.uint32) << np.uint32(bits // 8 * 8 + k)
    return out, size + last


def compress(ids: np.ndarray) -> bytes:
    """One segment."""
    number = np.zeros(int(ids.max(initial=0)) + 1, np.uint32)
    number[ids] = 1
    terminals = np.flatnonzero(number)
    number[terminals] = np.arange(len(terminals))
    seq = number[ids]
    rules, rounds = [np.empty(0, np.uint64)], []
    base = len(terminals)
    while len(seq) > 1:
        before = len(seq)
        seq, pairs = _round(seq, base)
        if len(pairs):
            base += len(pairs)
            rules.append(pairs)
            rounds.append(len(pairs))
        if before - len(seq) < LEAST_GAIN * before:
            break
    pairs = np.concatenate(rules)
    left, right = (pairs >> np.uint64(32)).astype(np.uint32), (pairs & np.uint64(2**32 - 1)).astype(np.uint32)
    spans = np.ones(base, np.uint32)
    begin = len(terminals)
    for n in rounds:
        spans[begin : begin + n] = spans[left[begin - len(terminals) :][:n]] + spans[right[begin - len(terminals) :][:n]]
        begin += n
    bits = max(1, int(base - 1).bit_length()) if base else 1
    longest = int(spans.max(initial=1))
    width = 1 if longest < 1 << 8 else 2 if longest < 1 << 16 else 4
    head = _SEGMENT.pack(len(ids), len(terminals), len(pairs), len(seq), len(rounds), bits, width)
    body = [terminals.astype("<u4"), np.array(rounds, "<u4"), spans[len(terminals) :].astype(f"<u{width}")]
    return b"".join([head, *(x.tobytes() for x in body), *(_packed(x, bits) for x in (left, right, seq))])


class Segment:
    """A stored segment; nothing is expanded until asked for."""

    def __init__(self, data: memoryview):
        self.ids, terminals, rules, symbols, rounds, bits, width = _SEGMENT.unpack_from(data)
        at = _SEGMENT.size

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        def symbols_of(n: int) -> np.ndarray:
            nonlocal at
            out, size = _unpacked(data[at:], n, bits)
            at += size
            return out

        self.terminals, self.rounds, self.spans = take(terminals, "<u4"), take(rounds, "<u4"), take(rules, f"<u{width}")
        self.left, self.right, self.symbols = symbols_of(rules), symbols_of(rules), symbols_of(symbols)
        self.size = at

    def _expand(self, seq: np.ndarray) -> np.ndarray:
        base = len(self.terminals) + len(self.left)
        seq = seq.astype(np.uint32)
        for n in reversed(self.rounds.tolist()):
            base -= n
            rule = base - len(self.terminals)
            is_pair = seq >= base
            times = is_pair + np.int64(1)
            first = (np.cumsum(times) - times)[is_pair]
            which = seq[is_pair].astype(np.int64) - base + rule
            seq = np.repeat(seq, times)
            seq[first], seq[first + 1] = self.left[which], self.right[which]
        return self.terminals[seq]

    def read(self, start: int = 0, length: int | None = None) -> np.ndarray:
        """Ids ``[start, start + length)`` of the segment; only the symbols that cover them are expanded."""
        if length is None:
            return self._expand(self.symbols)
        spans = np.concatenate([np.ones(len(self.terminals), np.int64), self.spans.astype(np.int64)])
        to = np.cumsum(spans[self.symbols])
        first = int(np.searchsorted(to, start, "right"))
        last = int(np.searchsorted(to, start + length, "left"))
        skip = start - (int(to[first - 1]) if first else 0)
        return self._expand(self.symbols[first : last + 1])[skip : skip + length]


class Shard:
    """The documents and segments of a payload."""

    def __init__(self, payload: bytes):
        magic, n, segments = _HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a shard")
        docs = np.frombuffer(payload, "<i8,u1,<i8", n, _HEAD.size)
        self.doc_ids = [int(d) if has else None for d, has in zip(docs["f0"], docs["f1"])]
        self.lengths = docs["f2"]
        at, view = _HEAD.size + docs.nbytes, memoryview(payload)
        self.segments = []
        for _ in range(segments):
            self.segments.append(Segment(view[at:]))
            at += self.segments[-1].size

    def read(self, start: int, length: int) -> np.ndarray:
        """Ids ``[start, start + length)`` of the shard."""
        parts = [np.empty(0, np.uint32)]
        for s in self.segments:
            if start < s.ids and length > 0:
                n = min(length, s.ids - start)
                parts.append(s.read(start, n))
                start, length = start + n, length - n
            start = max(0, start - s.ids)
        return np.concatenate(parts)

    def digests(self) -> Iterator[tuple[int | None, int, int, int]]:
        """doc_id, ids before it in the shard, its ids, and their crc32; one segment is expanded at a time."""
        stops = np.cumsum(self.lengths).tolist()
        k = at = crc = 0
        for s in self.segments:
            ids, used = np.ascontiguousarray(s.read(), "<u4"), 0
            while k < len(stops) and used < len(ids):
                n = min(len(ids) - used, stops[k] - at)
                crc = zlib.crc32(ids[used : used + n], crc)
                used, at = used + n, at + n
                if at == stops[k]:
                    yield self.doc_ids[k], stops[k] - int(self.lengths[k]), int(self.lengths[k]), crc
                    k, crc = k + 1, 0


def build_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    docs = np.empty(len(doc_ids), "<i8,u1,<i8")
    docs["f0"], docs["f1"] = [d or 0 for d in doc_ids], [d is not None for d in doc_ids]
    docs["f2"] = lengths
    segments = [compress(ids[i : i + SEGMENT_IDS]) for i in range(0, len(ids), SEGMENT_IDS)]
    return b"".join([_HEAD.pack(MAGIC, len(doc_ids), len(segments)), docs.tobytes(), *segments])


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode every text and write the shards (:data:`SHARDS`) in ascending doc_id order to ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, shard = encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids, lengths, held, n_held = [], [], [], 0

        def full() -> pa.RecordBatch:
            payload = build_shard(doc_ids, lengths, np.concatenate(held))
            row = [[part], [shard], [len(doc_ids)], [n_held], [payload]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names=["part", "shard", "n_docs", "n_ids", "payload"])

        for batch in batches:
            for block in blocks(batch, "text"):
                ids, n = enc.encode(block.column("text"), end_id)
                stops = np.cumsum(n)
                ids_of, begin = block.column("doc_id").to_pylist(), 0
                while begin < len(n):  # as many documents as fill the shard
                    before = int(stops[begin] - n[begin])
                    end = min(len(n), int(np.searchsorted(stops, before + SHARD_IDS - n_held)) + 1)
                    doc_ids += ids_of[begin:end]
                    lengths += n[begin:end].tolist()
                    held.append(ids[before : stops[end - 1]])
                    n_held += len(held[-1])
                    begin = end
                    if n_held >= SHARD_IDS:
                        yield full()
                        doc_ids, lengths, held, n_held, shard = [], [], [], 0, shard + 1
        if doc_ids:
            yield full()

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    picked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SHARDS).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the shards of ``path``; ``start`` counts
    the ids of all documents before it. Running totals run over the shards of a part, and over the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "shard", "payload"))):
                rows = [(part, shard, *x) for x in Shard(payload).digests()]
                kinds = (pa.int32(), pa.int32(), *[pa.int64()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    shards = spark.read.schema(SHARDS).parquet(path)
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    parts = sums.select("part", before(Window.orderBy("part")).alias("part_start"))
    starts = shards.select("part", "shard", before(Window.partitionBy("part").orderBy("shard")).alias("shard_start")).join(parts, "part")
    docs = shards.select("part", "shard", "payload").mapInArrow(run, "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    start = F.col("part_start") + F.col("shard_start") + F.col("inside")
    return docs.join(starts, ["part", "shard"]).select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")
