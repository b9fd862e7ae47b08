"""Toxicity: the automaton against plain edit distances, contexts, held-out labels, odd rows."""

import random
import zlib

import numpy as np
import pytest

from tradewind.llm import toxicity
from tradewind.llm.queries import queries

from .conftest import prose

TERMS = [("idiot", False), ("moron", False), ("disgusting", False), ("scum", False), ("rotten", True), ("filth", True), ("été", False)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def nearest(word):
    """(edits, term) by comparing with every term."""
    found = []
    for i, (term, prefix) in enumerate(TERMS):
        if prefix:
            found += [(0, i)] * word.startswith(term)
        elif distance(word, term) <= toxicity.allowed_edits(term, prefix):
            found.append((distance(word, term), i))
    return min(found, default=None)


@pytest.mark.parametrize("most", [toxicity.MOST_STATES, 5])
def test_automaton_equals_edit_distances(monkeypatch, most):
    monkeypatch.setattr(toxicity, "MOST_STATES", most)
    pick, words = random.Random(2), ["", "x", "rotte", "rottener", "idi", "idiotidiot"]
    for _ in range(3000):
        word = list(pick.choice(TERMS)[0])
        for _ in range(pick.randrange(5)):
            at, what = pick.randrange(len(word) + 1), pick.randrange(3)
            word[at : at + (what > 0)] = [] if what == 2 else [pick.choice("idotrmscué¤")]
        words.append("".join(word))
    automaton = toxicity.Automaton(TERMS)
    for at in range(0, len(words), 500):
        part = words[at : at + 500]
        text = np.array([ord(c) for c in "".join(part)], np.int64)
        ends = np.cumsum([len(w) for w in part])
        states = automaton.walked(text, ends - [len(w) for w in part], ends)
        assert [automaton.accepts[s] for s in states] == [nearest(w) for w in part]


def test_words():
    texts = ['He said: "Idiot!!" (st*pid)', None, "", " \n ", "...", "l'été—x y_z　ＺB", "a\nb"]
    words = toxicity.words_of(texts)
    got = [[words[i] for i in range(a, b)] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    assert got == [["he", "said", "idiot", "st*pid"], [], [], [], [], ["l'été—x", "y_z", "ｚb"], ["a", "b"]]
    assert toxicity.words_of([]).first.tolist() == [0]


def test_contexts():
    """Quoted, reported, addressed, shouted, beside another hit."""
    automaton = toxicity.Automaton(TERMS)

    def bits(text):
        hits = toxicity.hits_of(toxicity.words_of(["first line", text, "“"]), automaton, frozenset({"morons"}))
        return hits.context.astype(int).tolist(), hits.row.tolist()

    assert bits("what an idiot this is") == ([[0, 0, 0, 0, 0]], [1])
    assert bits("what an «idiot» this is") == ([[1, 0, 0, 0, 0]], [1])
    assert bits('it "is" an idiot "here"') == ([[0, 0, 0, 0, 0]], [1])
    assert bits('open " mark\nan idiot "here"') == ([[0, 0, 0, 0, 0]], [1])
    assert bits("the word idiot, no more") == ([[0, 1, 0, 0, 0]], [1])
    assert bits("you idiot!") == ([[0, 0, 1, 1, 0]], [1])
    assert bits("idiot " + "far " * 20 + "moron you " + "far " * 9 + "!") == ([[0] * 5, [0, 0, 1, 0, 0]], [1, 1])
    assert bits("idiot and moron, morons") == ([[0, 0, 0, 0, 1]] * 2, [1, 1])


@pytest.fixture(scope="module")
def trained(spark):
    """A model of made-up abuse: two words in toxic texts only, one near word in clean texts."""
    rows = []
    for i in range(300):
        text = prose(i, 60)
        toxic = i % 5 == 0
        text += " you" if i % 2 else " such"
        text += (" grobian" if i % 2 else " vermintide") * toxic + " grobiane x" * (i % 7 == 1 and not toxic)
        rows.append((i, text, int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    return toxicity.train(docs, labels)


def test_misspellings_are_caught_and_quotations_told_apart(spark, trained):
    assert {t for t, _ in trained.terms} == {"grobian", "vermintide"} and "grobiane" in trained.harmless
    text = prose(1000, 60)
    cases = {
        "clean": text, "empty": "", "term": f"{text} you grobian", "one edit": f"{text} you gr0bian go",
        "two edits": f"{text} you vermntidde go", "harmless": f"{text} two grobiane go", "far": f"{text} rob grain vermin tide",
        "quoted": f'{text} he called the word "grobian" an insult', "capitals": f"{text} YOU GROBIAN",
    }
    docs = spark.createDataFrame(list(cases.items()), "doc_id string, text string")
    got = {r.doc_id: r for r in toxicity.scored(docs, trained, ["doc_id"]).collect()}
    flagged = {k for k, r in got.items() if r.score >= 0.3}
    assert flagged == {"term", "one edit", "two edits", "capitals"}
    (hit,) = got["two edits"].hits
    assert (hit.word, hit.term, hit.edits) == ("vermntidde", "vermintide", 2) and cases["two edits"][hit.start :].startswith(hit.word)
    assert got["quoted"].hits[0].context < got["term"].hits[0].context - 3


def test_a_beginning_stands_for_its_words():
    units = [("krawum", False, 30, 0), ("krawumx", False, 9, 0), ("rest", False, 5, 900), ("rare", False, 2, 0)]
    units += [(f"schimpf{s}", False, 6, 1) for s in "abcdefgh"] + [("schimpf", True, 48, 8), ("schim", True, 49, 60), ("krawu", True, 34, 1)]
    got = [(u, prefix) for u, prefix, _, _ in toxicity.chosen_terms(units, 200, 1800)]
    assert set(got) == {("krawum", False), ("krawumx", False), ("schimpf", True)}


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    out = queries()["op12_toxicity"](spark, folder).collect()
    assert len(out) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in out[:200]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3)
    held = [(r.predicted, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    toxic = [p for p, y in held if y]
    assert len(toxic) > 80 and sum(toxic) >= 0.88 * len(toxic)  # the rest have no term left in them
    assert sum(p for p, y in held if not y) <= 0.01 * (len(held) - len(toxic))


def test_features_of_the_sample_are_those_of_scoring(trained):
    texts = ["you grobian grobian! gr0bian", "grobiane", "x", "a vermintide of words said \"vermintide\""]
    words = toxicity.words_of(texts)
    hits = toxicity.hits_of(words, toxicity.Automaton(trained.terms, trained.allowed), frozenset())
    met = []
    for i in range(len(texts)):
        own = np.flatnonzero(hits.row == i)
        bits = hits.context[own] @ (1 << np.arange(5))
        met.append({"n": int(words.first[i + 1] - words.first[i]), "word": [words[w] for w in hits.word[own]], "term": hits.term[own], "edits": hits.edits[own], "context": bits})
    real = toxicity.hits_of(words, toxicity.Automaton(trained.terms, trained.allowed), trained.harmless)
    assert np.allclose(toxicity._sample_features(met, trained), trained.features(words, real))


def test_odd_rows(spark, table, odd_pairs, trained):
    out = toxicity.scored(table(odd_pairs), trained, ["doc_id"]).collect()
    assert len(out) == len(odd_pairs) and all(0 <= r.score <= 1 for r in out)
    nothing = {round(r.score, 9) for r in out if r.doc_id in (3, 4, 5)}
    assert len(nothing) == 1
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None), (99, 1), (8, 0)], "doc_id long, label int")
    for docs in (table(odd_pairs), table([])):
        model = toxicity.train(docs, labels)
        assert len(toxicity.scored(docs, model, ["doc_id"]).collect()) == docs.count()
    clean = toxicity.train(table(odd_pairs), labels.where("label = 0"))
    assert clean.terms == [] and all(r.score < 0.5 for r in toxicity.scored(table(odd_pairs), clean, ["doc_id"]).collect())
