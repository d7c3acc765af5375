"""Quality rules with risk-controlled cutoffs. Built-in functions only.

Base rules reject a document that is short or mostly repeats itself. Beyond them, each rule rejects a document whose
rate passes a cutoff. Cutoffs are tightened along one path, fixed beforehand: a rule at a time, from the loosest to the
strictest. A step of the path is usable in a stratum (a language) if labelled good documents show that all rules at its
cutoffs together reject at most a share ``risk`` of them: the exact binomial probability of seeing so few rejections at
that share is at most ``error``, divided by the number of strata. Steps are tested in order until the first that isn't
usable, so that the steps of a stratum need no further correction, and the last usable one is taken; where there is none, as
with few labels, only the base rules hold. With probability ``1 - error`` no stratum falsely rejects more than
``risk`` of its good documents. At the defaults and four strata, 173 labels without a rejection are enough.

Defined cases: null text has no words and fails; null lang is the stratum ``und``; a document with several labels counts
as good if all are; without labels only the base rules hold; an empty table gives an empty result; equal rows are judged
alike; windows are compared by 64-bit hashes within one text; a very long text's words and lines are one value of a task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natspark.llm.common import GAP, free_name, stored

BLANK = " \t\n\x0b\x0c\r"
SYMBOL = r"[#*$%&|<>]"
MIN_WORDS = 50
RISK, ERROR = 0.025, 0.05
#: Rule: (count, total, cutoffs in thousandths of the total).
RULES: dict[str, tuple[str, str, tuple[int, ...]]] = {
    "symbols": ("n_symbols", "word_chars", (20, 50, 100, 200, 300)),
    "repeats": ("n_repeat_words", "n_words", (50, 100, 200, 300, 400)),
    "lines": ("n_dup_lines", "n_lines", (200, 300, 400, 600, 800)),
}
#: The path: (rule, cutoff) added or tightened at each step.
PATH = [(rule, RULES[rule][2][-1 - k]) for k in range(5) for rule in RULES]
FEATURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more. Only texts with such a window have their windows sorted."""
    size = F.size(words)
    windows = F.transform(
        F.when(size >= 3, F.sequence(F.lit(0), size - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]),
    )

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(s: Column) -> Column:
            last = F.size(s) - 1
            twice = F.filter(s, lambda x, j: F.when(j > 0, s[j - 1]["h"] == x["h"]).otherwise(False) | F.when(j < last, s[j + 1]["h"] == x["h"]).otherwise(False))
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(placed, count))

    return let(windows, covered)


def features(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and :data:`FEATURES` of every row; one pass, no shuffle."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = F.btrim(text, F.lit(BLANK))
    words = F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, GAP))
    by_words = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANK)) != "")
    by_lines = let(
        lines,
        lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")),
    )
    w, y = free_name(docs, "w"), free_name(docs, "y")
    made = docs.select(*columns, by_words.alias(w), by_lines.alias(y), F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"))
    return made.select(*columns, *(f"{w}.{c}" for c in ("n_words", "word_chars")), "n_symbols", f"{y}.n_lines", f"{y}.n_dup_lines", f"{w}.n_repeat_words")


def _log_gamma(x: Column) -> Column:
    """Stirling's series, after eight steps up; good to a double's precision for x >= 1."""
    y, below = x + 8, F.lit(0.0)
    for i in range(8):
        below = below + F.ln(x + i)
    return (y - 0.5) * F.ln(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - below


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p); 1 where k > n p. Terms fall from k down, and those that no longer change a
    double are left out."""
    k, n = k.cast("double"), n.cast("double")
    log_top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log1p(F.lit(-p))
    terms = F.least(k, F.ceil(40 * F.sqrt(n * p)) + 60).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] * (k - i + 1) * (1 - p) / ((n - k + i) * p)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    steps = F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(steps, start, step, lambda s: s["total"])
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.exp(log_top) * total)


def _passes(rule: str, cutoff: Column | int) -> Column:
    """Whether the rule's rate is beyond the cutoff; whole numbers only."""
    count, total, _ = RULES[rule]
    return 1000 * F.col(count) > cutoff * F.col(total)


def first_step() -> Column:
    """The first step of the path that rejects a document, or null."""
    return F.least(*(F.when(_passes(rule, cutoff), k) for k, (rule, cutoff) in enumerate(PATH)))


def cutoffs(made: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``stratum``, ``steps`` (how many of the path are usable) and, for each rule, its cutoff there or null. ``made`` has
    features, ``stratum``, ``base_failed`` and ``doc_id``; good documents that fail a base rule are not the cutoffs'
    affair."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    held = made.where(~F.col("base_failed")).join(good, "doc_id", "left_semi").withColumn("first", first_step())
    # A row a stratum; each counts what the first steps reject together.
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col("first") <= k).alias(f"k{k}") for k in range(len(PATH))))
    counts = stored(counts, "tests")
    level = counts.agg((F.lit(error) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("level"))
    tested = counts.crossJoin(F.broadcast(level)).select("stratum", "n", "level", F.posexplode(F.array(*(f"k{k}" for k in range(len(PATH))))).alias("step", "k"))
    # Rejections only grow along the path, so the usable steps are its first ones.
    usable = tested.where(binomial_tail(F.col("k"), F.col("n"), risk) <= F.col("level"))
    passed = usable.groupBy("stratum").agg((F.max("step") + 1).alias("steps"))
    at = {rule: F.least(*(F.when(F.col("steps") > k, c) for k, (r, c) in enumerate(PATH) if r == rule)) for rule in RULES}
    return passed.select("stratum", "steps", *(c.alias(f"{rule}_cutoff") for rule, c in at.items()))


def judged(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``doc_id``, the features, ``base_failed`` and ``kept`` of every row. Features are stored once, for the counts and
    for the verdicts."""
    picked = docs.select(F.col("doc_id"), F.col("lang"), F.col("text"))
    made = features(picked, ["doc_id", "lang"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    made = stored(made.withColumns({"stratum": F.coalesce("lang", F.lit("und")), "base_failed": failed}).drop("lang"), "features")
    chosen = stored(cutoffs(made, labels.select("doc_id", "quality"), risk, error), "cutoffs")
    rejected = F.coalesce(first_step() < F.col("steps"), F.lit(False))
    joined = made.join(chosen.select("stratum", "steps"), "stratum", "left")
    return joined.select("doc_id", *FEATURES, "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"))


def oracle(risk: float = RISK, error: float = ERROR) -> str:
    tests = ", ".join(f"({k}, '{r}', {c})" for k, (r, c) in enumerate(PATH))
    rate = " ".join(f"WHEN '{r}' THEN 1000 * {a} > cutoff * {b}" for r, (a, b, _) in RULES.items())
    return rf"""
WITH x AS (
  SELECT doc_id, coalesce(lang, 'und') AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS w FROM x, unnest(range(1, len(words) - 1)) AS u(i)
), twice AS (
  SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(3) AS r(j) GROUP BY doc_id
), f AS (
  SELECT x.doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM x LEFT JOIN rep USING (doc_id)
), b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
), tests(step, rule, cutoff) AS (VALUES {tests}), firsts AS (
  SELECT b.*, (SELECT min(step) FROM tests WHERE CASE rule {rate} END) AS first FROM b
), good AS (
  SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1
), counted AS (
  SELECT stratum, step, count(*) AS n, count(*) FILTER (first <= step) AS k
  FROM firsts JOIN good USING (doc_id), tests WHERE NOT base_failed GROUP BY ALL
), tails AS (
  SELECT *, CASE WHEN k > n * {risk} THEN 1 ELSE (
      SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk}) + (n - i) * ln(1 - {risk})))
      FROM range(k + 1) AS r(i)) END AS tail FROM counted
), chosen AS (
  SELECT stratum, max(step) + 1 AS steps FROM tails
  WHERE tail <= {error} / (SELECT count(DISTINCT stratum) FROM counted) GROUP BY ALL
)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(first < steps, false) AS kept FROM firsts LEFT JOIN chosen USING (stratum)
"""
