"""Near dedup by SimHash: fingerprints, a byte-position inverted index with count filtering, and components.

Fingerprints of 64 bits that differ in two bits at most agree in six of their eight bytes at least. Single bytes would
make lists of 1/256 of all fingerprints, so the index posts each distinct fingerprint under the bytes at every five of
the eight positions, 56 keys; with six equal bytes, two share six of these at least. Shared keys are tallied for each
pair of a posting list; pairs that reach six are kept and verified bit by bit.

A list longer than ``LONG`` is not paired up but split by a further position: its members are posted anew under the
bytes at every six positions, of which two with six equal bytes share one at least. Lists that are still too long agree
in six bytes, and are split by bits: each member is posted under its other two bytes as they are and with one bit
changed. Two differ in two bits at most if and only if they share one of these lists, and none has more than 17 members.
So neither lists nor pairs grow with the square of a group, and no pair is lost: where one shares a long list, both of
it are members of that list and meet in the next index.

Components come from minimum labels with hooking and pointer jumping over stored tables, until nothing changes.

Defined cases: a text without words has fingerprint zero and links like any other; null text has no words; null doc_ids
never name a component unless all of its are null; a very long text is hashed whole, alone in its block; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natspark.llm.common import stored
from natspark.llm.tokens import blocks

SEED = 42
#: Not a parameter: the least tallies and the last split by bits lose pairs that differ in more bits.
DISTANCE = 2
LONG = 64
#: Bytes of a key, in the first index and in that of long lists.
SIZES = (5, 6)
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PIECE = 1 << 18


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of a text as an unsigned number: A-Z lower-cased, words split at ASCII white space, word shingles with
    repeats; a bit is set if more than half of the shingles' XXH64 have it."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    plain = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n], ends[len(words) - n :])
    counts = np.zeros((8, 8), np.int64)
    hashes = (xxh64_intdigest(plain[a:b], SEED) for a, b in spans)
    for begin in range(0, n, _PIECE):
        h = np.fromiter(hashes, np.uint64, min(_PIECE, n - begin)).view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            counts[byte] += np.bincount(h[:, byte], minlength=256) @ _BITS
    return int.from_bytes(np.packbits((2 * counts > n).ravel(), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, text_hash, print``, the fingerprint as a signed number. One pass over the texts, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in (b for batch in batches for b in blocks(batch, "text")):
            prints = np.array([fingerprint(bytes(t.as_buffer()), shingle) if t.is_valid else 0 for t in block.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("text_hash"), pa.array(prints.view(np.int64))], names=["doc_id", "text_hash", "print"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(run, "doc_id long, text_hash long, print long")


#: What names a posting list: the positions, as a mask, and the bytes there.
LIST = ["mask", "bytes"]


def _postings(prints: DataFrame, size: int) -> DataFrame:
    """``print, mask, bytes``: each fingerprint under the bytes at every ``size`` positions."""
    masks = [_signed(sum(255 << 8 * p for p in positions)) for positions in combinations(range(8), size)]
    posted = prints.select("print", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    return posted.select("print", "mask", F.col("print").bitwiseAND(F.col("mask")).alias("bytes"))


def _near(pairs: DataFrame, least: int) -> DataFrame:
    """Pairs (``a, b``, a row for each key they share) that share ``least`` keys and differ in two bits at most."""
    tally = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= least)
    return tally.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE).select("a", "b")


def links(prints: DataFrame) -> DataFrame:
    """``a, b`` with a < b: links between distinct fingerprints (``print``) that join all that differ in two bits at
    most; of a long posting list, a star around each meeting point."""
    found = []
    for size in SIZES:
        # Lists of two, nearly all that have more than one, are a pair as they are; only longer ones are read again.
        lists = _postings(prints, size).groupBy(*LIST).agg(F.count(F.lit(1)).alias("n"), F.min("print").alias("a"), F.max("print").alias("b"))
        lists = stored(lists.where("n > 1"), "lists")
        posted = stored(_postings(prints, size).join(lists.where("n > 2").select(*LIST, "n").hint("shuffle_hash"), LIST), "postings")
        short = posted.where(F.col("n") <= LONG)
        pairs = short.select(*LIST, F.col("print").alias("a")).join(short.select(*LIST, F.col("print").alias("b")), LIST).where("a < b")
        found.append(_near(lists.where("n = 2").select("a", "b").unionByName(pairs.select("a", "b")), comb(8 - DISTANCE, size)))
        long = posted.where(F.col("n") > LONG)
        prints = stored(long.select("print").distinct(), "of-long-lists")
    bits = F.array(*(F.lit(_signed(1 << b if b >= 0 else 0)) for b in range(-1, 64)))
    split = long.select("print", *LIST, F.explode(bits).alias("bit")).where(F.col("bit").bitwiseAND(F.col("mask")) == 0)
    met = split.groupBy(*LIST, F.col("print").bitwiseXOR(F.col("bit")).alias("point")).agg(F.sort_array(F.collect_set("print")).alias("of"))
    star = met.where(F.size("of") > 1).select(F.col("of")[0].alias("a"), F.explode(F.slice("of", 2, 17)).alias("b"))
    for more in found:
        star = star.unionByName(more)
    return star.distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for the nodes of ``edges`` (``a, b``): the smallest node that each can reach. Each round takes
    the least label of the neighbours, hooks whole label groups on to it, and jumps along labels once."""
    edges = stored(edges, "edges")
    both = stored(edges.union(edges.select("b", "a")), "neighbours")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        seen = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen"))
        least = labels.join(seen, "node").select("node", "label", F.least("label", "seen").alias("least"))
        hooks = stored(least.groupBy("label").agg(F.min("least").alias("to")), "hooks")
        hooked = hooks.join(hooks.select(F.col("label").alias("to"), F.col("to").alias("next")), "to", "left").select("label", F.coalesce("next", "to").alias("to"))
        hooked = stored(hooked, "hooked")
        if hooked.where("label <> to").isEmpty():
            return labels
        labels = stored(labels.join(hooked, "label").select("node", F.col("to").alias("label")), "labels")


def grouped(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, text_hash, print, component_id`` of every row; the component is named by its smallest doc_id. Rows meet their
    component by fingerprint, from stored tables, so that a fingerprint with a large share of the rows is split."""
    prints = stored(fingerprints(docs, shingle), "prints")
    distinct = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct")
    labels = components(links(distinct.select("print")))
    named = distinct.join(labels.withColumnRenamed("node", "print"), "print", "left").select("print", "first", F.coalesce("label", "print").alias("label"))
    named = stored(named, "named")
    ids = stored(named.groupBy("label").agg(F.min("first").alias("component_id")), "components")
    of_print = stored(named.join(ids, "label").select("print", "component_id"), "of_print")
    return prints.join(of_print, "print").select("doc_id", "text_hash", "print", "component_id")
