"""Language of texts by a linear-chain conditional random field over words.

A word's evidence is a sum of weights of its byte n-grams, its affixes (n-grams that touch the word's ends, and its
first and last four bytes) and its place in a lexicon of frequent words. Start weights and transition weights between
the languages of neighbouring words are learnt too, so that a switch of language inside a text can be followed. Words
are labelled by forward-backward; a text's language is the one with the largest sum of word probabilities, its score
that sum's share.

Many texts make one chain: at a text's first word the transition is replaced by the start distribution, which forgets
all before. The chain is cut into strips that numpy handles side by side; each strip's transfer matrix first carries
the state to the next strip, so the result is that of the whole chain. Likewise a chain is worked off in pieces of
``PIECE`` words, so that memory beyond a text's words doesn't grow with its length. Evidence is computed once for each
distinct word of a block.

The model is fitted on a sample of about ``rows`` documents of each language, chosen by a hash of the id outside the
held-out fold; of a document longer than ``SPAN`` characters it takes one span of that length, at a place chosen by the
hash. So the driver holds at most about ``rows * SPAN`` characters a language. Labels are given for documents, so
code-switched texts are made: of each ``SWITCH`` sampled documents the last goes on where the one before ends. Weights
of a transition are learnt inside texts only. Everything else covers all texts, whole.

Defined cases: null text, and text without a letter, is ``und`` with score 0; rows without lang teach nothing; rows
without doc_id are not held out, and teach nothing; without any labelled text all is ``und``; equal rows get equal
results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natspark.llm.tokens import blocks
from natspark.llm.toxicity import held_out

SAMPLE_ROWS, SPAN, LEXICON = 400, 20_000, 4000
SWITCH = 4
SLOTS = 1 << 16
STRIP = 64
#: Words worked off together; strips must fill it.
PIECE = 1 << 16
_DROP = {ord(c): None for c in string.punctuation + string.digits}
_NEWLINE = 10


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(slot, word) pairs: the features of each word, as slots of the weight table."""
    clean = "\n".join(words).lower().translate(_DROP).split("\n")
    data = np.frombuffer(f"\n{'\n'.join(clean)}\n\n\n\n".encode(), np.uint8)
    end = data == _NEWLINE
    word = np.cumsum(end) - 1  # a newline opens the word after it
    slots, of = [], []
    for n in (2, 3, 4):
        m = len(data) - n + 1
        code = np.zeros(m, np.uint64)
        inside = np.zeros(m, bool)
        for k in range(n):
            code = code * np.uint64(257) + data[k : m + k]
            if 0 < k < n - 1:
                inside |= end[k : m + k]
        valid = ~inside & (word[:m] < len(words)) & ~(end[:m] & end[n - 1 :])
        slots.append(((code[valid] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) >> np.uint64(48)).astype(np.int64))
        of.append(word[:m][valid])
    for k, w in enumerate(clean):
        if (place := lexicon.get(w)) is not None:
            slots.append([SLOTS + place])
            of.append([k])
    return np.concatenate(slots).astype(np.int64), np.concatenate(of).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray  # slots x languages
    transitions: np.ndarray  # log weights, from x to
    start: np.ndarray

    def evidence(self, words: list[str]) -> np.ndarray:
        """Log weights of each word for each language, from 0 for the least likely."""
        slots, of = word_features(words, self.lexicon)
        out = np.stack([np.bincount(of, self.weights[slots, k], len(words)) for k in range(len(self.languages))], 1)
        return out


def _strips(evidence: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """The chain in strips: factors of words, openings of texts, factors of transitions and of starts, and the transfer
    matrix of each strip up to a factor."""
    n, k = evidence.shape
    strips = max(1, -(-n // STRIP))
    e = np.ones((strips * STRIP, k))
    e[:n] = np.exp(evidence - evidence.max(1, keepdims=True))
    e = e.reshape(strips, STRIP, k)
    opens = np.ones(strips * STRIP, bool)  # what fills up the last strip is forgotten at once
    opens[:n] = first
    opens = opens.reshape(strips, STRIP)
    a, pi = np.exp(transitions - transitions.max()), np.exp(start - start.max())
    carry = np.broadcast_to(np.eye(k), (strips, k, k)).copy()
    for t in range(STRIP):
        moved = carry @ a
        o = opens[:, t]
        moved[o] = carry[o].sum(2)[:, :, None] * pi
        carry = moved * e[:, t, None, :]
        carry /= carry.sum((1, 2), keepdims=True)
    return e, opens, a, pi, carry


def borders(carry: np.ndarray, enter: np.ndarray | None = None, leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The state in which each of these transfer matrices is entered, and the backward state in which it is left."""
    n, k = carry.shape[:2]
    enters, leaves = np.empty((n, k)), np.empty((n, k))
    state = np.ones(k) / k if enter is None else enter
    for s in range(n):
        enters[s] = state
        state = state @ carry[s]
        state /= state.sum()
    state = np.ones(k) / k if leave is None else leave
    for s in reversed(range(n)):
        leaves[s] = state
        state = carry[s] @ state
        state /= state.sum()
    return enters, leaves


def transfer(evidence: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The transfer matrix of a part of a chain, up to a factor; its strips must be full."""
    carry = _strips(evidence, first, transitions, start)[-1]
    whole = carry[0]
    for one in carry[1:]:
        whole = whole @ one
        whole /= whole.sum()
    return whole


def marginals(
    evidence: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray, enter: np.ndarray | None = None, leave: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities of each word's language, exactly those of the whole chain; also the (unnormalised) forward and
    backward weights. ``first`` marks the words that open a text; ``enter`` and ``leave`` are the states at the ends of
    a part of a chain."""
    n, k = evidence.shape
    e, opens, a, pi, carry = _strips(evidence, first, transitions, start)
    enter, leave = borders(carry, enter, leave)
    forward, backward = np.empty_like(e), np.empty_like(e)
    state = enter
    for t in range(STRIP):
        moved = state @ a
        o = opens[:, t]
        moved[o] = state[o].sum(1)[:, None] * pi
        state = moved * e[:, t]
        state /= state.sum(1, keepdims=True)
        forward[:, t] = state
    state = leave
    for t in reversed(range(STRIP)):
        backward[:, t] = state
        weighed = state * e[:, t]
        moved = weighed @ a.T
        o = opens[:, t]
        moved[o] = (weighed[o] @ pi)[:, None]
        state = moved / moved.sum(1, keepdims=True)
    forward, backward = forward.reshape(-1, k)[:n], backward.reshape(-1, k)[:n]
    both = forward * backward
    return both / both.sum(1, keepdims=True), forward, backward


def split_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of these texts, as a dictionary array, and the number of words of each; every text has one at least,
    if only an empty one."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    return lists.flatten().dictionary_encode(), np.diff(lists.offsets.to_numpy()).astype(np.int64)


def fit(texts: list[str], languages: list[str], rounds: int = 6, rate: float = 0.5) -> Model:
    """Maximum likelihood by AdaGrad over parts of one chain of all texts, in an order that mixes the languages."""
    names = sorted(set(languages))
    place = {name: i for i, name in enumerate(names)}
    words, n = split_words(pa.array(texts, pa.string()))
    distinct, index = words.dictionary.to_pylist(), words.indices.to_numpy().astype(np.int64)
    gold = np.repeat([place[x] for x in languages], n)
    k = len(names)
    count = np.bincount(index, minlength=len(distinct))
    clean = ["".join(w.lower().translate(_DROP).split("\n")) for w in distinct]
    order = np.argsort(-count, kind="stable")
    lexicon: dict[str, int] = {}
    for i in order:
        if len(lexicon) == LEXICON or count[i] < 5:
            break
        if clean[i]:
            lexicon.setdefault(clean[i], len(lexicon))
    slots, of = word_features(distinct, lexicon)
    weights, seen = np.zeros((SLOTS + LEXICON, k)), np.full((SLOTS + LEXICON, k), 1e-6)
    transitions, t_seen = np.zeros((k, k)), np.full((k, k), 1e-6)
    start, s_seen = np.zeros(k), np.full(k, 1e-6)
    begins = (np.cumsum(n) - n)[np.arange(len(n)) % SWITCH != SWITCH - 1]  # the others go on where the text before ends
    opens = np.zeros(len(index), bool)
    opens[begins] = True
    parts = max(1, len(index) // 60_000)
    edges = np.unique(begins[np.searchsorted(begins, np.linspace(0, begins[-1], parts, endpoint=False))])
    edges = np.append(edges, len(index))
    for _ in range(rounds):
        for a, b in zip(edges[:-1], edges[1:]):
            table = np.stack([np.bincount(of, weights[slots, j], len(distinct)) for j in range(k)], 1)
            e = table[index[a:b]]
            first = opens[a:b]
            p, forward, backward = marginals(e, first, transitions, start)
            want = np.zeros_like(p)
            want[np.arange(b - a), gold[a:b]] = 1
            off = p - want
            by_word = np.stack([np.bincount(index[a:b], off[:, j], len(distinct)) for j in range(k)], 1)
            gradient = np.stack([np.bincount(slots, by_word[of, j], SLOTS + LEXICON) for j in range(k)], 1) / (b - a) + 1e-6 * weights
            seen += gradient**2
            weights -= rate * gradient / np.sqrt(seen)
            s_gradient = off[first].mean(0) + 1e-4 * start
            inside = np.flatnonzero(~first)  # words with one before them in their text
            if len(inside):
                step = np.exp(e[inside] - e[inside].max(1, keepdims=True)) * backward[inside]
                joint = forward[inside - 1, :, None] * np.exp(transitions)[None] * step[:, None, :]
                joint /= joint.sum((1, 2), keepdims=True)
                real = np.bincount(gold[a:b][inside - 1] * k + gold[a:b][inside], minlength=k * k).reshape(k, k)
                t_gradient = (joint.sum(0) - real) / (b - a) + 1e-4 * transitions
                t_seen += t_gradient**2
                transitions -= 0.3 * rate * t_gradient / np.sqrt(t_seen)
            s_seen += s_gradient**2
            start -= 0.3 * rate * s_gradient / np.sqrt(s_seen)
    return Model(names, lexicon, weights.astype(np.float32), transitions, start)


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where("doc_id is not null and text is not null and lang is not null").where(~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    share = F.lit(-1.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, rows / n) * 1_000_000).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    spare = F.greatest(F.length("text") - SPAN, F.lit(0))
    span = F.substring("text", (1 + F.pmod(F.xxhash64("doc_id", F.lit(1)), spare + 1)).cast("int"), F.lit(SPAN))
    sample = known.where(place < share).withColumn("text", span).toPandas()
    if not len(sample):
        return None
    sample = sample.iloc[np.argsort([hash_of(d) for d in sample["doc_id"]], kind="stable")]
    return fit(sample["text"].tolist(), sample["lang"].tolist())


def hash_of(doc_id: int) -> int:
    """An order of ids that has nothing to do with their languages."""
    return int(doc_id) * 0x9E3779B97F4A7C15 % (1 << 64)


def labelled(texts: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    words, n = split_words(texts)
    distinct = words.dictionary.to_pylist()
    lettered = np.array([any(map(str.isalpha, w)) for w in distinct], bool)
    index = words.indices.to_numpy().astype(np.int64)
    first = np.zeros(len(index), bool)
    starts = np.cumsum(n) - n
    first[starts] = True
    of_text = np.repeat(np.arange(len(n)), n)
    evidence = model.evidence(distinct)
    cuts = range(0, len(index), PIECE)
    enter, leave = np.full((2, len(cuts), len(model.languages)), 1 / len(model.languages))
    if len(cuts) > 1:
        matrices = [transfer(evidence[index[a : a + PIECE]], first[a : a + PIECE], model.transitions, model.start) for a in cuts]
        enter, leave = borders(np.stack(matrices))
    sums = np.zeros((len(n), len(model.languages)))
    for piece, a in enumerate(cuts):
        part = index[a : a + PIECE]
        p, _, _ = marginals(evidence[part], first[a : a + PIECE], model.transitions, model.start, enter[piece], leave[piece])
        p[~lettered[part]] = 0
        here = of_text[a : a + PIECE]
        for k in range(len(model.languages)):
            sums[here[0] : here[-1] + 1, k] += np.bincount(here - here[0], p[:, k])
    counted = np.add.reduceat(lettered[index].astype(float), starts)
    best = sums.argmax(1)
    score = sums[np.arange(len(n)), best] / np.maximum(counted, 1)
    return [model.languages[b] if c else "und" for b, c in zip(best, counted)], np.where(counted > 0, np.clip(score, 0, 1), 0.0)


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; one pass, no shuffle."""
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                if model is None:
                    lang, score = ["und"] * len(block), np.zeros(len(block))
                else:
                    lang, score = labelled(block.column("text"), model)
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(lang), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    made = picked.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return made.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
