"""Toxicity scores from a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, turns look-alike letters, digits and signs into the letters they stand for, and leaves words with
single spaces. Lexicon entries are whole words and word beginnings, weighed by the log odds of their documents in
labelled data; a beginning stands for all words that it starts. Exception phrases are pairs of neighbouring words around
an entry that labelled clean documents hold and toxic ones don't; a match inside one doesn't count. The matches'
weights, summed and also normalised by the text's length, go through a logistic curve.

Labels are learnt from a sample of at most about ``rows`` labelled documents of each label, chosen by a hash of the id,
never from the held-out fold (crc32 of the id modulo 5 is 0); what it gives is bounded: ``entries`` lexicon entries and
as many exceptions. Scoring reads every whole text in one pass without a shuffle.

Defined cases: null and empty texts have no match and score as such; a document with several labels is toxic if one
says so; a very long text is swept whole, alone in its block; rows without doc_id are not held out and carry no label; without labels of both kinds every score is 0; an
empty table gives an empty result; extra columns are kept by :func:`keep`; equal rows score alike.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natspark.llm.common import free_name, stored
from natspark.llm.tokens import blocks

SAMPLE_ROWS, ENTRIES = 6000, 5000
PREFIXES = range(4, 9)
#: An entry is in this share of the toxic sample at least and in so many of its documents, and its log odds, less so
#: many standard errors, reach this weight: what a few documents have by chance doesn't, however many terms are tried.
LEAST_SHARE, LEAST_DOCS, LEAST_WEIGHT, ERRORS = 0.01, 4, 2.0, 2.0

# Letters of other scripts, digits and signs, and the Latin letters they are used for.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "α": "a", "β": "b", "ε": "e", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}

_LETTERS = str.maketrans(LOOK_ALIKES | DIGITS | {"​": None, "‌": None, "‍": None, "­": None})
_SIGN = re.compile(r"(?<=\w)[@$!|](?=\w)|(?<!\S)[@$](?=\w)")
_GAP = re.compile(r"[\W_]+")


def folded(text: str | None) -> str:
    """Folded words, each with a space before and after."""
    text = (text or "").lower()
    if any(s in text for s in SIGNS):
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return f" {_GAP.sub(' ', text.translate(_LETTERS)).strip()} "


def terms(words: Iterable[str]) -> set[str]:
    """Lexicon candidates: words (with a closing space) and their beginnings, each with an opening space."""
    out = set()
    for w in words:
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in PREFIXES if n < len(w))
    return out


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, ...] = (-math.inf, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        if len(found):
            found.make_automaton()
        return found

    def matches(self, automaton, text: str) -> list[tuple[int, float]]:
        """(start, weight) of the heaviest entry at each word that counts, in folded ``text``."""
        if not len(automaton):
            return []
        at: dict[int, float] = {}
        free: list[tuple[int, int]] = []
        for end, (size, weight) in automaton.iter(text):
            start = end - size + 1
            if weight is None:
                free.append((start, end))
            elif weight > at.get(start, 0):
                at[start] = weight
        begins, ends = [], []  # of the exceptions, where they overlap as one
        for a, b in sorted(free):
            if ends and a <= ends[-1]:
                ends[-1] = max(ends[-1], b)
            else:
                begins.append(a)
                ends.append(b)
        place = {s: bisect_right(begins, s) - 1 for s in at} if begins else {}
        return [(s, w) for s, w in at.items() if place.get(s, -1) < 0 or s >= ends[place[s]]]

    def evidence(self, automaton, text: str) -> tuple[float, float]:
        """Sum of the weights, and the same for a hundred words."""
        total = sum(w for _, w in self.matches(automaton, text))
        return math.log1p(total), math.log1p(100 * total / max(1, text.count(" ") - 1))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(np.clip(-(a + b * evidence[:, 0] + c * evidence[:, 1]), -50, 50)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``text, toxic``: labelled documents outside the held-out fold, about ``rows`` of each label."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    share = F.lit(-1.0)
    for label, n in counts.items():
        share = F.when(F.col("toxic") == label, min(1.0, rows / n) * 1_000_000).otherwise(share)
    chosen = known.where(place < share).limit(4 * rows)  # twice what is expected: the proven bound of what is broadcast
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _counted(sample: DataFrame, wanted: set[str] | None) -> DataFrame:
    """``term, docs`` over the sample's texts: all terms, or the wanted ones. Summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found = terms(set(folded(text).split()))
                seen.update(found if wanted is None else found & wanted)
            if len(seen) > 500_000:
                yield pa.RecordBatch.from_pydict({"term": list(seen), "docs": list(seen.values())})
                seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "docs"])

    return sample.select("text").mapInArrow(run, "term string, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))


def _phrases(sample: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``phrase, toxic, docs``: the neighbouring words around each match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            rows = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                text = folded(text)
                around = set()
                for start, _ in lexicon.matches(automaton, text):
                    end = text.index(" ", start + 1)
                    if start:
                        around.add(text[text.rindex(" ", 0, start) : end + 1])
                    if end + 1 < len(text):
                        around.add(text[start : text.index(" ", end + 1) + 1])
                rows += [(p, toxic) for p in around]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], names=["phrase", "toxic"])

    found = sample.select("text", F.col("toxic").cast("int")).mapInArrow(run, "phrase string, toxic int")
    return found.groupBy("phrase").agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") != 1).alias("clean"))


def _evidence(docs: DataFrame, lexicon: Lexicon, kept: str) -> DataFrame:
    """``kept, total, rate`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for block in (b for batch in batches for b in blocks(batch, "text")):
            values = np.array([lexicon.evidence(automaton, folded(t.as_py())) for t in block.column("text")], float).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([block.column(kept), pa.array(values[:, 0]), pa.array(values[:, 1])], names=[kept, "total", "rate"])

    kind = docs.schema[kept].dataType.simpleString()
    return docs.select(kept, F.col("text").cast("string").alias("text")).mapInArrow(run, f"`{kept}` {kind}, total double, rate double")


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> tuple[float, ...]:
    """Logistic regression of three weights by Newton steps; classes count the same."""
    design = np.column_stack([np.ones(len(x)), x])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y != 1).sum()))
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -50, 50)))
        gradient = design.T @ (weight * (p - y)) + penalty * beta * [0, 1, 1]
        hessian = (design.T * (weight * p * (1 - p))) @ design + np.diag([1e-9, penalty, penalty])
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, entries: int = ENTRIES) -> Lexicon:
    sample = stored(_sample(docs, labels, rows), "toxicity-sample")
    size = {bool(r["toxic"]): r["count"] for r in sample.groupBy((F.col("toxic") == 1).alias("toxic")).count().collect()}
    if len(size) < 2:
        return Lexicon()
    toxic, clean = sample.where("toxic = 1"), sample.where("toxic <> 1")
    least = max(LEAST_DOCS, LEAST_SHARE * size[True])
    often = _counted(toxic, None).where(F.col("docs") >= least).orderBy(F.desc("docs"), "term").limit(20 * entries)
    in_toxic = {r["term"]: r["docs"] for r in often.collect()}
    in_clean = {r["term"]: r["docs"] for r in _counted(clean, set(in_toxic)).collect()}
    weight, sure = {}, []
    for term, n in in_toxic.items():
        m = in_clean.get(term, 0)
        weight[term] = math.log((n + 0.5) / (size[True] + 1)) - math.log((m + 0.5) / (size[False] + 1))
        if weight[term] - ERRORS * math.sqrt(1 / (n + 0.5) + 1 / (m + 0.5)) >= LEAST_WEIGHT:
            sure.append(term)
    chosen: dict[str, float] = {}
    for term in sorted(sure, key=lambda t: (len(t), t)):
        shorter = [chosen[term[: n + 1]] for n in PREFIXES if term[: n + 1] in chosen]
        if not shorter or weight[term] > max(shorter) + 1:
            chosen[term] = weight[term]
    top = sorted(chosen, key=lambda t: (-chosen[t] * in_toxic[t], t))[:entries]
    lexicon = Lexicon({t: chosen[t] for t in top})
    innocent = _phrases(sample, lexicon).where((F.col("clean") >= 3) & (F.col("clean") * size[True] > 20 * F.col("toxic") * size[False]) & (F.col("toxic") <= 1))
    lexicon.exceptions = [r["phrase"] for r in innocent.orderBy(F.desc("clean"), "phrase").limit(entries).collect()]
    known = _evidence(sample, lexicon, "toxic").toPandas()
    lexicon.curve = _fit(known[["total", "rate"]].to_numpy(), (known["toxic"] == 1).to_numpy(float))
    return lexicon


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, score`` of every row."""
    a, b, c = (float(x) for x in lexicon.curve)
    made = _evidence(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), lexicon, "doc_id")
    if math.isinf(a):
        return made.select("doc_id", F.lit(0.0).alias("score"))
    return made.select("doc_id", (1 / (1 + F.exp(-(a + b * F.col("total") + c * F.col("rate"))))).alias("score"))


def keep(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; one pass, no shuffle."""
    columns, text = docs.columns, free_name(docs, "folded")
    wide = docs.withColumn(text, F.col("text").cast("string"))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for block in (b for batch in batches for b in blocks(batch, text)):
            values = np.array([lexicon.evidence(automaton, folded(t.as_py())) for t in block.column(text)], float).reshape(-1, 2)
            stays = lexicon.score(values) < threshold
            yield block.select(columns).filter(pa.array(stays))

    return wide.mapInArrow(run, schema)
