"""Cross-tokenizer alignment: where the tokens of two tokenizers meet and overlap in a text, and how many documents hold
each pair of ids that overlaps.

A task works on blocks of texts as Arrow tables. The tokens of a block are one flat column for each tokenizer, with
parent indices and, by segmented cumulative sums of token sizes, the byte where each ends in its document. A hash join on
the document-end keys finds the ends that both have; its outer rows, in order, with ids filled backwards, are the links:
each stretch between two neighbouring ends belongs to one token of either side. Tokens between two shared ends are a
group. Documents that hold a pair are counted per block by ``Table.group_by``, and Spark adds the blocks' counts.

Counts then go back to the blocks that hold the pair, one row for each block and pair, and are joined there with the
block's documents: nothing that grows with the corpus is broadcast, and texts are encoded once.

Texts are encoded by the pieces between single spaces: neither tokenizer has a token that spans a space inside a text, so
that a text's ids are those of its pieces laid end to end. Where a space touches other white space, the text is one
piece. A block's distinct pieces are encoded once and short ones remembered.

Defined cases: null and empty texts, and texts whose joined token bytes differ from a space and the text on either side,
have no tokens: zeros and an empty string. Rows of one doc_id or none are documents of their own. Very long texts are a
block of their own, so that a task holds one text's tokens at least. An empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natspark.llm.common import stored
from natspark.llm.tokens import blocks

BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"
#: Bytes of text a block holds, and pieces and their characters remembered; they bound a task's memory.
BLOCK_BYTES = 2 << 20
REMEMBERED = 400_000
REMEMBERED_CHARS = 16 << 20
#: White space beyond the plain space, as either tokenizer may see it.
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{180e}\x{feff}\p{Z}]"
_ODD = f"^{_WHITE}| {_WHITE}|{_WHITE} | $"
#: Bits of a packed key that hold the end of a token, and of a packed pair that hold the second id.
_END_BITS, _ID_BITS = 40, 20


class _Pieces:
    """Ids of pieces by one tokenizer: a growing pool of ids, where each piece begins in it and how many it has."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.pool, self.used = np.empty(1 << 20, np.int32), 0
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def add(self, at: int, ids: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(lengths.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        while at + len(ids) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.pool[self.used : self.used + total] = np.fromiter((i for x in ids for i in x), np.int32, total)
        self.start[at : at + len(ids)] = self.used + np.cumsum(lengths) - lengths
        self.length[at : at + len(ids)] = lengths
        self.used += total

    def lists(self, places: np.ndarray) -> pa.ListArray:
        """The ids of the pieces at ``places``, as a list each."""
        lengths = self.length[places]
        to = np.cumsum(lengths)
        total = int(to[-1]) if len(to) else 0
        ids = self.pool[np.arange(total) + np.repeat(self.start[places] - (to - lengths), lengths)]
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], to]).astype(np.int32)), pa.array(ids))


class TwoTokenizers:
    """Both tokenizers over blocks of texts, with the bytes of every token."""

    def __init__(self, byte_path: str, piece_path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.remembered = remembered
        self.byte_level = Tokenizer.from_file(byte_path)
        self.byte_level.encode_special_tokens = True
        self.pieces = SentencePieceProcessor(model_file=piece_path)
        letters = _byte_letters()
        vocab = self.byte_level.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.bytes_b = [self._piece_bytes(i) for i in range(self.pieces.get_piece_size())]
        self.sizes = tuple(np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.text_a, self.text_b = _numbers(len(self.bytes_a), b",|"), _numbers(len(self.bytes_b), b",;")
        self.index: dict[str, int] = {}
        self.chars = 0
        self.ids = (_Pieces(), _Pieces())
        self.whole = np.zeros(1 << 16, bool)

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def _learn(self, new: list[str]) -> None:
        at = len(self.index)
        a = [e.ids for e in self.byte_level.encode_batch_fast([f" {w}" for w in new], add_special_tokens=False)]
        b = self.pieces.encode(new, num_threads=1)
        for of, ids in zip(self.ids, (a, b)):
            of.add(at, ids)
        while at + len(new) > len(self.whole):
            self.whole = np.concatenate([self.whole, np.zeros_like(self.whole)])
        for k, (w, x, y) in enumerate(zip(new, a, b), at):
            plain = f" {w}".encode()
            self.whole[k] = b"".join(map(self.bytes_a.__getitem__, x)) == plain == b"".join(map(self.bytes_b.__getitem__, y))
        self.index.update(zip(new, range(at, at + len(new))))
        self.chars += sum(map(len, new))

    def encode(self, texts: pa.Array) -> tuple[pa.ListArray, pa.ListArray]:
        """Both tokenizers' ids of each text; none where it has no tokens."""
        if len(self.index) > self.remembered or self.chars > REMEMBERED_CHARS:
            self.index.clear()
            self.chars = 0
            for of in self.ids:
                of.forget()
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD)
        plain, whole = texts.filter(pc.invert(odd)), texts.filter(odd)
        alone = pa.ListArray.from_arrays(pa.array(np.arange(len(whole) + 1, dtype=np.int32)), whole)
        lists = pa.concat_arrays([pc.split_pattern(plain, " "), alone])
        order = np.argsort(np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable"))
        lists = lists.take(pa.array(order))
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.to_pylist()
        self._learn([w for w in distinct if w not in self.index])
        places = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))[words.indices.to_numpy()]
        # A text has tokens if all of its pieces do.
        fails = np.concatenate([[0], np.cumsum(~self.whole[places])])
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        good = (np.diff(fails[ends]) == 0) & (pc.binary_length(texts).to_numpy() > 0)
        out = []
        for of in self.ids:
            parts = of.lists(places)
            at = parts.offsets.to_numpy()[ends]
            flat, counts = parts.flatten().to_numpy(), np.diff(at)
            flat = flat[np.repeat(good, counts)]
            out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts * good)]).astype(np.int32)), pa.array(flat)))
        return out[0], out[1]


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level tokenizers write for each byte: printable Latin-1 stands for itself, the others for
    the letters from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def _numbers(n: int, signs: bytes) -> pa.Array:
    """Each number below ``n`` as decimal text, before the first and then before the second of two signs."""
    return pa.array([b"%d%c" % (i, sign) for sign in signs for i in range(n)], pa.binary())


@functools.lru_cache(maxsize=2)
def tokenizers(byte_path: str | None = None, piece_path: str | None = None) -> TwoTokenizers:
    """The tokenizers of this Python worker; paths default to the public files of the box."""
    if byte_path is None or piece_path is None:
        import public_tokenizers

        byte_path, piece_path = byte_path or public_tokenizers.path(BYTE_TOKENIZER), piece_path or public_tokenizers.path(PIECE_TOKENIZER)
    return TwoTokenizers(byte_path, piece_path)


def _tokens(ids: pa.ListArray, sizes: np.ndarray, name: str) -> pa.Table:
    """``at, name``: each token under the key of its document and the byte where it ends there."""
    flat, parents = ids.flatten().to_numpy(), pc.list_parent_indices(ids).to_numpy()
    ends = np.cumsum(sizes[flat])
    first = ids.offsets.to_numpy()
    before = np.concatenate([[0], ends])[first[:-1]]
    return pa.table({"at": parents.astype(np.int64) << _END_BITS | (ends - before[parents]), name: flat})


def _group_texts(two: TwoTokenizers, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> pa.Array:
    """Of each document ``a1,a2|b1;a3|b2,b3``: ids of both sides by group, in order."""
    n_groups = int(group_a[-1]) + 1 if len(group_a) else 0
    until_a, until_b = np.cumsum(np.bincount(group_a, minlength=n_groups)), np.cumsum(np.bincount(group_b, minlength=n_groups))
    # A token closes its side of the group if the next one is of another.
    row_a = a + len(two.bytes_a) * np.append(np.diff(group_a) > 0, [True] * (len(a) > 0))
    row_b = b + len(two.bytes_b) * np.append(np.diff(group_b) > 0, [True] * (len(b) > 0))
    rows = np.empty(len(a) + len(b), np.int64)
    rows[np.arange(len(a)) + np.concatenate([[0], until_b])[group_a]] = row_a
    rows[np.arange(len(b)) + until_a[group_b]] = row_b + len(two.text_a)
    texts = pa.concat_arrays([two.text_a, two.text_b]).take(pa.array(rows))
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[: len(rows) + 1][first_a + first_b] if len(rows) else np.zeros(len(first_a), np.int64)
    joined = memoryview(data) if data is not None else memoryview(b"")
    # The sign after the last id goes.
    return pa.array([str(joined[x : max(x, y - 1)], "ascii") for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.string())


def align_block(two: TwoTokenizers, texts: pa.Array) -> tuple[pa.Table, pa.Table]:
    """Of a block of texts: a row for each text (``n_a, n_b, n_groups, n_links, groups``), and ``doc, pair, times`` for
    each pair of ids linked in a text, with the number of its links there."""
    ids_a, ids_b = two.encode(texts)
    n = len(texts)
    a, b = _tokens(ids_a, two.sizes[0], "a"), _tokens(ids_b, two.sizes[1], "b")
    both = a.join(b, "at", join_type="full outer", use_threads=False).combine_chunks()
    both = both.take(pc.sort_indices(both["at"]))
    has_a, has_b = (pc.is_valid(both[c]).to_numpy() for c in ("a", "b"))
    shared = has_a & has_b
    doc = both["at"].to_numpy() >> _END_BITS
    group = np.cumsum(shared) - shared
    fill_a, fill_b = (pc.fill_null_backward(both[c]).to_numpy() for c in ("a", "b"))
    links = pa.table({"doc": doc, "pair": fill_a.astype(np.int64) << _ID_BITS | fill_b.astype(np.int64)})
    pairs = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "pair", "times"])
    groups = _group_texts(two, a["a"].to_numpy(), b["b"].to_numpy(), group[has_a], group[has_b], ids_a.offsets.to_numpy().astype(np.int64), ids_b.offsets.to_numpy().astype(np.int64))
    counts = {"n_a": ids_a.value_lengths(), "n_b": ids_b.value_lengths(), "n_groups": np.bincount(doc[shared], minlength=n), "n_links": np.bincount(doc, minlength=n)}
    rows = pa.table({k: pc.cast(pa.array(v) if isinstance(v, np.ndarray) else v, pa.int64()) for k, v in counts.items()} | {"groups": groups})
    return rows, pairs


_ROWS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, counts array<int>"


def _lists(values: pa.Array, doc: np.ndarray, n: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int32)), values)


def blocks_of(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """A row for each document, with the pairs of ids linked in it and how often; and for each block one row without
    counts of tokens, with the block's pairs and the number of its documents that hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = tokenizers(byte_path, piece_path)
        # A task's number goes in front, so that blocks of one written table have numbers of their own.
        number = TaskContext.get().partitionId() << 32
        for block in (b for batch in batches for b in blocks(batch, "text", BLOCK_BYTES)):
            rows, pairs = align_block(two, block.column("text"))
            pairs = pairs.sort_by([("doc", "ascending"), ("pair", "ascending")]).combine_chunks()
            held = pairs.group_by("pair", use_threads=False).aggregate([([], "count_all")]).combine_chunks()
            n = block.num_rows
            doc = pairs["doc"].to_numpy()
            per_doc = [_lists(pairs["pair"].combine_chunks(), doc, n), _lists(pc.cast(pairs["times"].combine_chunks(), pa.int32()), doc, n)]
            columns = [pa.array(np.full(n, number)), block.column("doc_id"), *(rows[c].combine_chunks() for c in rows.column_names), *per_doc]
            names = [c.split()[0] for c in _ROWS.split(", ")]
            out = pa.RecordBatch.from_arrays(columns, names=names)
            yield out
            whole = {"pairs": [held["pair"].to_numpy()], "counts": [held["count_all"].to_numpy().astype(np.int32)], "block": [number]}
            yield pa.RecordBatch.from_arrays([pa.array(whole[f.name], f.type) if f.name in whole else pa.nulls(1, f.type) for f in out.schema], schema=out.schema)
            number += 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _ROWS)


def pair_counts(of_blocks: DataFrame) -> DataFrame:
    """``pair, docs, best``: how many documents hold each linked pair of ids, and whether no other pair of its first id is
    in more of them."""
    parts = of_blocks.where("n_a is null").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    total = stored(parts.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("docs")), "pairs")
    first = F.shiftright("pair", _ID_BITS)
    most = stored(total.groupBy(first.alias("a")).agg(F.max("docs").alias("most")), "most")
    return total.join(most, first == most.a).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """A block's documents with their links' counts summed and those of the best pairs numbered."""
    lists = docs["pairs"].combine_chunks()
    flat = pa.table({"doc": pc.list_parent_indices(lists), "pair": lists.flatten(), "times": pc.cast(docs["counts"].combine_chunks().flatten(), pa.int64())})
    met = flat.join(counts.select(["pair", "docs", "best"]), "pair", join_type="inner", use_threads=False)
    sums = pa.table({"doc": met["doc"], "n_best": pc.multiply(met["times"], pc.cast(met["best"], pa.int64())), "count_sum": pc.multiply(met["times"], met["docs"])})
    sums = sums.group_by("doc", use_threads=False).aggregate([("n_best", "sum"), ("count_sum", "sum")])
    out = docs.drop_columns(["block", "pairs", "counts"])
    at = sums["doc"].to_numpy()
    for name in ("n_best", "count_sum"):
        full = np.zeros(docs.num_rows, np.int64)
        full[at] = sums[f"{name}_sum"].to_numpy()
        out = out.append_column(name, pa.array(full))
    return out


def align(docs: DataFrame, groups: Column | None = None, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum`` of every row. ``groups`` is the column to keep of the text
    ``groups``: by default all of it."""
    made = blocks_of(docs, byte_path, piece_path).withColumn("groups", F.col("groups") if groups is None else groups)
    of_blocks = stored(made, "blocks")
    counts = stored(pair_counts(of_blocks), "pair-counts")
    wanted = of_blocks.where("n_a is null").select(F.col("block").alias("to"), F.explode("pairs").alias("pair"))
    back = wanted.join(counts.hint("shuffle_hash"), "pair").select("to", "pair", "docs", "best")
    per_doc = of_blocks.where("n_a is not null")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in per_doc.drop("block", "pairs", "counts").schema) + ", n_best long, count_sum long"
    return per_doc.groupBy("block").cogroup(back.groupBy("to")).applyInArrow(_scored, schema)
