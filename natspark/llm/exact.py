"""Exact dedup of whole texts by content-defined chunk recipes. Built-in functions only.

Texts are equal if they are identical without white space. A normalised text is cut where its content says so: after a
five-character window whose first, third and fifth character are of one class, at least 256 and at most 4096
characters from the last cut. Chunks move once, as (hash, chunk), counted before the shuffle; two chunks with one hash
get different ordinals, so (hash, ordinal) is a verified identifier. A document's recipe, the ordered list of its
identifiers, is made where its text is read; only recipes are grouped and joined, never long texts.

Of equal texts the row with the most characters stays, then the smallest doc_id (null last), then one row of equal ones.

Defined cases: null text is empty, and all empty texts are one group; equal rows with one doc_id are copies of each
other; a very long text is read whole, its chunks as one value of a task, and never moves; an empty table gives an empty result; extra columns are kept by :func:`keep` and ignored by :func:`decisions`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natspark.llm.common import GAP, free_name, stored

#: Latin letters, digits and signs whose code is 3 modulo 8, and an eighth of the Han and Hangul signs, as ranges.
_CLASS = "".join(rf"\x{{{c:X}}}" for c in range(0x23, 0x100) if c % 8 == 3) + r"\x{4E00}-\x{57FF}\x{AC00}-\x{B1FF}"
CHUNK = rf"(?s).{{251,4091}}?[{_CLASS}].[{_CLASS}].[{_CLASS}]|.{{1,4096}}"


def normalised(text: Column) -> Column:
    return F.coalesce(F.regexp_replace(text, GAP, ""), F.lit(""))


def chunks(text: Column) -> Column:
    """The chunks of a normalised text, in order; laid end to end they are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def chunk_store(docs: DataFrame) -> DataFrame:
    """``hash, chunk, uses``: each distinct chunk once."""
    # The outer form, as for the other Spark tests the list before it is exploded, and so makes it twice.
    parts = docs.select(F.explode_outer(chunks(normalised(F.col("text")))).alias("chunk")).where("chunk is not null")
    return parts.groupBy(chunk_hash(F.col("chunk")).alias("hash"), "chunk").agg(F.count(F.lit(1)).alias("uses"))


def _collided(docs: DataFrame) -> DataFrame | None:
    """``hash, chunk, ordinal`` of chunks that share their hash with a smaller chunk. That no two do is the rule, which
    is verified over all chunks in one pass; only if some do is there another over the chunks of their hashes."""
    shared = chunk_store(docs).groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    shared = stored(shared, "shared")
    if shared.isEmpty():
        return None
    chunk = stored(chunk_store(docs).join(shared, "hash", "left_semi").select("hash", "chunk"), "doubtful")
    pairs = chunk.join(chunk.select("hash", F.col("chunk").alias("other")), "hash").where("other < chunk")
    return stored(pairs.groupBy("hash", "chunk").agg(F.count(F.lit(1)).cast("int").alias("ordinal")), "collided")


def recipes(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, text_sha256, recipe, marks, row``: the ordered verified identifiers of each row's chunks, as
    hashes and, where a hash isn't unique, (position, ordinal)."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = text.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"), normalised(F.col("text")).alias("plain"))
    hashes = F.transform(chunks(F.col("plain")), lambda c: chunk_hash(c))
    made = read.select("doc_id", "n_chars", F.sha2("plain", 256).alias("text_sha256"), hashes.alias("recipe"), F.monotonically_increasing_id().alias("row"))
    made = stored(made, "recipes")
    collided = _collided(text)
    if collided is None:
        return made.withColumn("marks", F.array().cast("array<struct<at:int,ordinal:int>>"))
    plain = normalised(F.col("text"))
    placed = text.select(F.posexplode(chunks(plain)).alias("at", "chunk"), F.sha2(plain, 256).alias("text_sha256"))
    placed = placed.withColumn("hash", chunk_hash(F.col("chunk"))).join(collided, ["hash", "chunk"])
    marks = placed.groupBy("text_sha256").agg(F.array_sort(F.collect_set(F.struct("at", "ordinal"))).alias("marks"))
    joined = made.join(marks, "text_sha256", "left")
    return joined.withColumn("marks", F.coalesce("marks", F.array().cast("array<struct<at:int,ordinal:int>>")))


def decisions(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, n_chars`` of every row.

    Groups are aggregated from recipes map-side first and stored, so that the join back to the rows has a shuffle of its
    own on either side and a group that holds a large share of all rows is split between tasks.
    """
    made = recipes(docs)
    first = F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"), F.col("row").alias("d"))
    groups = made.groupBy("recipe", "marks").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size"))
    groups = stored(groups.select("recipe", "marks", F.col("first.c").alias("keep_id"), F.col("first.d").alias("keep_row"), "group_size"), "groups")
    return made.join(groups, ["recipe", "marks"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256", "n_chars"
    )


def keep(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that :func:`decisions` drops. Rows are found by doc_id and text; where several rows
    agree in both, one of them stays."""
    sha, doc = free_name(docs, "sha"), free_name(docs, "doc")
    made = stored(decisions(docs), "decisions")
    key = [F.col("doc_id").alias(doc), F.col("text_sha256").alias(sha), F.col("n_chars").alias("n")]
    per_row = made.select(*key, "kept").groupBy(doc, sha, "n").agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept"))
    chosen = per_row.where("kept").withColumnsRenamed({doc: "k1", sha: "k2", "n": "k3", "rows": "k4"}).drop("kept")
    rows = docs.withColumns({sha: F.sha2(normalised(F.col("text").cast("string")), 256), doc: F.col("doc_id").cast("long")})
    n_chars = F.coalesce(F.length(F.col("text").cast("string")), F.lit(0))
    chosen = chosen.select(*(F.col(c).alias(free_name(docs, c)) for c in chosen.columns))
    k1, k2, k3, k4 = chosen.columns
    same = F.col(doc).eqNullSafe(F.col(k1)) & (F.col(sha) == F.col(k2)) & (n_chars == F.col(k3))
    found = rows.join(chosen, same).select(*docs.columns, sha, k4)
    single = found.where(F.col(k4) == 1).select(*docs.columns)
    repeated = found.where(F.col(k4) > 1).dropDuplicates(["doc_id", sha]).select(*docs.columns)
    return single.unionByName(repeated)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, text_sha256 FROM r
"""
