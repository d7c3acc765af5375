import math
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from natspark.llm import quality

from .fixtures import HARD, docs_of, prose


@pytest.mark.parametrize("k, n, p", [(0, 1, 0.01), (0, 500, 0.01), (3, 900, 0.01), (9, 900, 0.01), (40, 9000, 0.01), (5, 30, 0.3), (0, 0, 0.01), (200, 1000, 0.3)])
def test_binomial_tail(spark, k, n, p):
    got = spark.range(1).select(quality.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
    q = Fraction(p)
    want = 1.0 if k > n * p else float(sum(math.comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1)))
    assert got == pytest.approx(want, rel=1e-9)


def spam(k):
    return " ".join(f"{w}###" for w in prose(80, 500 + k).split())


def corpus():
    good = [(1000 + k, prose(60 + k % 40, k, 5000), ("en", "de", None)[k % 3], "a") for k in range(2400)]
    bad = [(4000 + k, spam(k), ("en", "de", None)[k % 3], "a") for k in range(60)]
    return good + bad + [(9000, spam(1), "xx", "a"), (9001, "a b c\n" * 30 + prose(80, 3, 5000), "en", "a")] + HARD[:-2]


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def brute_features(text):
    text = text or ""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    seen, windows = {}, [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(covered)


def test_features(spark):
    rows = corpus()
    got = quality.features(docs_of(spark, rows), ["doc_id"]).collect()
    assert sorted(str((r.doc_id, *r[1:])) for r in got) == sorted(str((r[0], *brute_features(r[1]))) for r in rows)


def test_verdicts_equal_sql_and_spare_unknown_strata(spark):
    rows = [r for r in corpus() if r[0] != 12]
    labels = [(r[0], int(1000 <= r[0] < 4000)) for r in rows if r[0] is not None and r[0] % 50]
    docs = docs_of(spark, rows)
    got = quality.judged(docs, labels_of(spark, labels)).collect()
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang").toPandas())
    con.register("labels", labels_of(spark, labels).toPandas())
    want = con.execute(quality.oracle()).fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[k] for k in range(1000, 3400)) and not any(kept[k] for k in range(4000, 4060)) and kept[9000]


def test_cutoffs_of_the_given_documents(spark):
    """Equal to SQL where cutoffs act, not base rules alone."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.judged(docs, labels).collect()
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    want = con.execute(quality.oracle()).fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(not r.kept and not r.base_failed for r in got) > 30


def test_steps_stop_at_the_first_that_is_not_usable(spark):
    """Rejections only grow along the path; a stratum's union of rules stays below the risk."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    kept = quality.judged(docs, labels).join(docs.select("doc_id", "lang"), "doc_id").join(labels.where("quality = 1").select("doc_id"), "doc_id").where("not base_failed")
    shares = {r.lang: (r.n, r.lost) for r in kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("kept")).alias("lost")).collect()}
    assert set(shares) == {"de", "en", "es", "fr"} and all(lost <= quality.RISK * n for n, lost in shares.values())
    bad = quality.judged(docs, labels).join(docs.select("doc_id", "lang"), "doc_id").where("not base_failed and not kept")
    assert {r.lang for r in bad.select("lang").distinct().collect()} == {"de", "en", "es", "fr"}


def test_cutoffs_need_evidence(spark):
    rows = [r for r in corpus() if 1000 <= (r[0] or 0) < 1100] + [(4000, spam(0), "en", "a")]
    assert {r.kept for r in quality.judged(docs_of(spark, rows), labels_of(spark, [(r[0], 1) for r in rows])).collect()} == {True}
    assert {r.kept for r in quality.judged(docs_of(spark, rows), labels_of(spark, [])).collect()} == {True}


def test_a_cutoff_that_rejects_good_documents_is_not_used(spark):
    """Half of the labelled good documents hold many signs: no cutoff on signs below their rate can be proven."""
    good = [(k, spam(k) if k % 2 else prose(80, k, 5000), "en", "a") for k in range(1500)]
    got = quality.judged(docs_of(spark, good), labels_of(spark, [(k, 1) for k in range(1500)])).collect()
    assert sum(not r.kept for r in got) <= 15


def test_empty_table(spark):
    assert quality.judged(docs_of(spark, []), labels_of(spark, [])).count() == 0
