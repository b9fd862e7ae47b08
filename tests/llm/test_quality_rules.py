"""Quality rules: statistics against plain Python, the fit on known mixtures, verdicts on labels."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradewind.llm import quality
from tradewind.llm.queries import queries
from tradewind.session import keep

from .conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    out = queries()["op3_quality_rules"](spark, SMALL).collect()
    assert len(out) == len(docs)
    for r in out:
        want = brute(docs[r.doc_id])
        assert tuple(r[c] for c in COLUMNS) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)


def test_plan_has_no_python(spark):
    plan = queries()["op3_quality_rules"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_verdicts_agree_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    out = [r for r in queries()["op3_quality_rules"](spark, folder).collect() if r.doc_id in labels]
    bad = [r.kept for r in out if labels[r.doc_id] == 0]
    good = [r.kept for r in out if labels[r.doc_id] == 1 and not r.base_failed]
    assert sum(bad) <= 0.05 * len(bad) and sum(good) >= 0.95 * len(good)


def test_odd_rows(spark, table, odd_pairs):
    pairs = [*odd_pairs, (30, "a b c d e f a b c d e x\na b\na b\n \n\x85\n\x85"), (31, "x " * 30), (32, "\x1c\x1d a\x0bb\x0cc\rd")]
    out, _ = quality.scored(table(pairs), ["doc_id"], keep)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in out.collect())
    assert got == sorted(brute(t) for _, t in pairs)


def test_empty_table(spark, table):
    out, model = quality.scored(table([]), ["doc_id"], keep)
    assert out.count() == 0 and model.prior == quality.PRIOR


def test_fit_finds_the_rates_of_a_mixture():
    pick = random.Random(3)
    found = (0.5, 0.4, 0.6, 0.3)
    counts = Counter()
    for _ in range(20_000):
        good = pick.random() < 0.7
        vote = tuple(0 if pick.random() < 0.1 else -1 if pick.random() < (0.0003 if good else f) else 1 for f in found)
        counts[vote] += 1
    model = quality.fit(list(counts.items()), ["a", "b", "c", "d"])
    assert model.prior == pytest.approx(0.7, abs=0.05)
    assert model.bad == pytest.approx(found, abs=0.06)
    assert all(g <= quality.FALSE_ALARM for g in model.good)
    # The order of the counts does not matter.
    assert quality.fit(list(counts.items())[::-1], ["a", "b", "c", "d"]) == model


def test_sentences_end_in_any_script(spark, table):
    """Prose that ends its sentences with other full stops is not called a single long sentence."""
    ends = {1: ".", 2: "।", 3: "。", 4: "۔", 5: "։", 6: "።", 7: ""}
    pairs = [(i, " ".join(f"word{k}" + (mark if k % 10 == 9 else "") for k in range(100))) for i, mark in ends.items()]
    found = table(pairs).select("doc_id", quality.statistics(F.col("text")).alias("s"))
    votes = {r.doc_id: (r.s.n_stops, r.s.vote_sentences) for r in quality.with_votes(found, "s").collect()}
    assert votes == {i: (10, 1) if mark else (0, -1) for i, mark in ends.items()}
