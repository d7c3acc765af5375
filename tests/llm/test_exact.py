import hashlib
import re

from pyspark.sql import functions as F

from natspark.llm import exact

from .fixtures import HARD, LONG, docs_of


def brute(rows):
    """The decisions, and the rows that stay."""
    groups = {}
    for k, (doc_id, text, *_) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, k))
    out, stays = [], []
    for plain, members in groups.items():
        best = min(members)[3]
        stays.append((rows[best][0], rows[best][1]))
        sha = hashlib.sha256(plain.encode()).hexdigest()
        out += [(rows[k][0], rows[best][0], len(members), k == best, sha) for *_, k in members]
    return out, stays


def key(rows):
    return sorted(map(str, rows))


def same(spark, rows):
    docs = docs_of(spark, rows)
    decided, stays = brute(rows)
    # Of rows that are equal in all, any one may be the one that stays.
    assert key(tuple(r) for r in exact.decisions(docs).drop("n_chars").collect()) == key(decided)
    kept = exact.keep(docs)
    assert kept.columns == docs.columns
    assert key((r.doc_id, r.text) for r in kept.collect()) == key(stays)


def test_hard_rows(spark):
    same(spark, HARD)


def test_empty_table(spark):
    assert exact.decisions(docs_of(spark, [])).count() == 0
    assert exact.keep(docs_of(spark, [])).count() == 0


def test_chunks_are_the_text_and_follow_its_content(spark):
    cut = lambda t: spark.createDataFrame([(t,)], "t string").select(exact.chunks(exact.normalised(F.col("t")))).first()[0]
    plain = "".join(LONG.split())
    parts = cut(LONG)
    assert "".join(parts) == plain and len(parts) > 10 and max(map(len, parts)) <= 4096
    shifted = cut("some other words first " + LONG)
    assert len(set(parts) & set(shifted)) > 0.7 * len(parts)


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """With a hash of three values every chunk collides, and texts are still equal only if they are identical."""
    monkeypatch.setattr(exact, "chunk_hash", lambda c: F.pmod(F.xxhash64(c), F.lit(3)))
    got = exact.decisions(docs_of(spark, HARD)).drop("n_chars").collect()
    assert key(tuple(r) for r in got) == key(brute(HARD)[0])
