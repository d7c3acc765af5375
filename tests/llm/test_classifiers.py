import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from natspark.llm import language, toxicity

from .fixtures import HARD, docs_of, prose

# Folding.


@pytest.mark.parametrize(
    "text, want",
    [("Idiot!", " idiot "), ("1d10t", " idiot "), ("ѕсum", " scum "), ("m0r0n,", " moron "), ("l@ser $cum", " laser scum "), ("a_b--c", " a b c "), (None, "  "), ("", "  "), ("id​iot", " idiot ")],
)
def test_folding(text, want):
    assert toxicity.folded(text) == want


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def toxic_corpus():
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(900):
        words = prose(rng.randrange(5, 60), k).split()
        toxic = k % 3 == 0
        if toxic:
            bad = rng.choice(["grubolo", "Grubolo!", "gru8olo", "grubоlo", "vexi" + rng.choice(["ta", "lum", "nor"])])
            words.insert(rng.randrange(len(words) + 1), bad)
        elif k % 14 == 0:
            words[1:1] = ["harmless", "grubolo"]
        rows.append((k, " ".join(words), "en", "a"))
        labels.append((k, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def lexicon(spark):
    rows, labels = toxic_corpus()
    return toxicity.learn(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_documents_are_told_apart(spark, lexicon):
    rows, labels = toxic_corpus()
    toxic = {d: t for d, _, t in labels}
    got = {r.doc_id: r.score for r in toxicity.scored(docs_of(spark, rows), lexicon).collect()}
    wrong = [d for d, s in got.items() if held(d) and (s >= 0.5) != toxic[d]]
    assert sum(map(held, got)) > 100 and len(wrong) <= 1
    assert any("harmless" in e for e in lexicon.exceptions) and " vexi" in lexicon.weights


def test_matches_equal_brute_force(lexicon):
    automaton = lexicon.automaton()
    for text, *_ in itertools.chain(((r[1],) for r in toxic_corpus()[0]), ((r[1],) for r in HARD if len(r[1] or "") < 5000)):
        text = toxicity.folded(text)
        best = {}
        for term, weight in lexicon.weights.items():
            for at in range(len(text)):
                if text.startswith(term, at):
                    best[at] = max(best.get(at, 0), weight)
        free = [(at, at + len(e)) for e in lexicon.exceptions for at in range(len(text)) if text.startswith(e, at)]
        want = {(at, w) for at, w in best.items() if not any(a <= at < b for a, b in free)}
        assert set(lexicon.matches(automaton, text)) == want


def test_hard_rows_are_scored_and_kept(spark, lexicon):
    docs = docs_of(spark, [*HARD, (77, "you grubolo grubolo", "en", "a")])
    got = toxicity.scored(docs, lexicon).collect()
    assert len(got) == len(HARD) + 1 and all(0 <= r.score <= 1 for r in got)
    kept = toxicity.keep(docs, lexicon)
    assert kept.columns == docs.columns and kept.count() == len(HARD) and kept.where("doc_id = 77").isEmpty()


def test_without_labels(spark):
    docs = docs_of(spark, HARD)
    none = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r.score for r in toxicity.scored(docs, none).collect()} == {0.0}
    assert toxicity.keep(docs, none).count() == len(HARD)
    assert toxicity.scored(docs_of(spark, []), none).count() == 0


# Languages.


def brute_marginals(evidence, first, transitions, start):
    """Sums over all label sequences of each text."""
    n, k = evidence.shape
    out = np.zeros((n, k))
    stops = [*np.flatnonzero(first)[1:], n]
    for a, b in zip(np.flatnonzero(first), stops):
        total = 0.0
        for labels in itertools.product(range(k), repeat=b - a):
            score = start[labels[0]] + sum(evidence[a + t, y] for t, y in enumerate(labels)) + sum(transitions[x, y] for x, y in zip(labels, labels[1:]))
            weight = np.exp(score)
            total += weight
            for t, y in enumerate(labels):
                out[a + t, y] += weight
        out[a:b] /= total
    return out


@pytest.mark.parametrize("strip", [1, 3, 64])
def test_forward_backward(monkeypatch, strip):
    monkeypatch.setattr(language, "STRIP", strip)
    rng = np.random.default_rng(strip)
    evidence, transitions, start = rng.normal(0, 2, (17, 3)), rng.normal(0, 1, (3, 3)), rng.normal(0, 1, 3)
    first = np.zeros(17, bool)
    first[[0, 1, 8, 14]] = True
    got, _, _ = language.marginals(evidence, first, transitions, start)
    assert np.allclose(got, brute_marginals(evidence, first, transitions, start))


@pytest.mark.parametrize("strip, piece", [(1, 1), (3, 6), (64, 64)])
def test_pieces_give_the_result_of_the_whole_chain(monkeypatch, model, strip, piece):
    texts = pa.array([" ".join(speech("aa", 20, 1) + speech("bb", 25, 2)), "12", None, " ".join(speech("cc", 90, 3)), "x"], pa.string())
    lang, score = language.labelled(texts, model)
    monkeypatch.setattr(language, "STRIP", strip)
    monkeypatch.setattr(language, "PIECE", piece)
    got, scores = language.labelled(texts, model)
    assert got == lang and np.allclose(scores, score)


SYLLABLES = {"aa": ["ba", "ti", "ko", "lu"], "bb": ["sch", "ung", "der", "keit"], "cc": ["ción", "ñar", "que", "los"]}


def speech(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return [("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4)))) for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    texts = [(" ".join(speech(lang, 60, k)), lang) for k in range(40) for lang in SYLLABLES]
    return language.fit([t for t, _ in texts], [x for _, x in texts])


def test_code_switches_are_followed(model):
    words = speech("aa", 15, 900) + speech("cc", 15, 901) + speech("bb", 15, 902)
    coded, n = language.split_words(pa.array([" ".join(words)]))
    evidence = model.evidence(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    first = np.zeros(45, bool)
    first[0] = True
    p, _, _ = language.marginals(evidence, first, model.transitions, model.start)
    want = ["aa"] * 15 + ["cc"] * 15 + ["bb"] * 15
    assert sum(model.languages[k] == w for k, w in zip(p.argmax(1), want)) >= 43
    assert (np.diag(model.transitions) > model.transitions.max(1, where=~np.eye(3, dtype=bool), initial=-9)).all()


def test_starts_are_learnt():
    texts = [(" ".join(speech(lang, 20, k)), lang) for k in range(60) for lang in ("aa", "aa", "aa", "bb")]
    random.Random(1).shuffle(texts)
    start = language.fit([t for t, _ in texts], [x for _, x in texts]).start
    assert start[0] > start[1]


def test_a_long_text_teaches_one_span(spark, monkeypatch):
    rows = [(k, " ".join(speech("aa" if k % 2 else "bb", 40, k)), "aa" if k % 2 else "bb", "a") for k in range(60)]
    docs = docs_of(spark, [*rows, *((100 + k, " ".join(speech("cc", 4000, k)), "cc", "a") for k in range(12))])
    seen = []
    monkeypatch.setattr(language, "fit", lambda texts, languages: seen.extend(zip(texts, languages)))
    monkeypatch.setattr(language, "SPAN", 500)
    language.learn(docs, 60)
    whole = {r[1] for r in rows}
    assert len(seen) > 40 and all(len(t) == 500 for t, x in seen if x == "cc") and all(t in whole for t, x in seen if x != "cc")


def test_texts_are_labelled(model):
    texts = [" ".join(speech(lang, 12, 700 + k)) for k in range(20) for lang in SYLLABLES]
    odd = [None, "", " \n ", "123 !?", "12 " + texts[0]]
    lang, score = language.labelled(pa.array(texts + odd, pa.string()), model)
    assert lang[:60] == list(SYLLABLES) * 20 and lang[60:] == ["und", "und", "und", "und", "aa"]
    assert (score[:60] > 0.5).all() and (score[60:64] == 0).all()


def test_learnt_on_one_fold_and_applied_to_all(spark):
    rows = [(k * 3 + j, " ".join(speech(lang, 30, k)), lang, "a") for k in range(120) for j, lang in enumerate(SYLLABLES)]
    docs = docs_of(spark, rows + HARD)
    got = language.identified(docs, language.learn(docs.where("doc_id > 20 or doc_id is null").unionByName(docs_of(spark, [(5000, None, "dd", "a")])), 60)).collect()
    assert len(got) == len(rows) + len(HARD)
    right = [r.lang_pred == {d: x for d, _, x, _ in rows}[r.doc_id] for r in got if r.doc_id is not None and r.doc_id > 20 and r.held_out]
    assert len(right) > 30 and sum(right) >= 0.97 * len(right)
    assert {r.held_out == held(r.doc_id) for r in got if r.doc_id is not None} == {True}


def test_nothing_to_learn_from(spark):
    docs = docs_of(spark, [(k, t, None, s) for k, t, _, s in HARD])
    assert {r.lang_pred for r in language.identified(docs, language.learn(docs)).collect()} == {"und"}
    assert language.identified(docs_of(spark, []), None).count() == 0
