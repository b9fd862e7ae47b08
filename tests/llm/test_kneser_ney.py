"""Language models against a direct count in plain Python."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tradewind.llm import kneser_ney
from tradewind.llm.queries import queries

from .conftest import SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return (text or "").translate(LOWER).encode().split()


def brute(order, train, texts):
    """(score, base score, known tokens) of each text under a model of the texts ``train``."""
    raw, counts = Counter(), {m: Counter() for m in range(1, order + 1)}
    for words in map(tokens, train):
        line = ["<s>"] * (order - 1) + words + ["</s>"]
        for p in range(order - 1, len(line)):
            raw[line[p]] += 1
            counts[order][tuple(line[p - order + 1 : p + 1])] += 1
    for m in range(order - 1, 0, -1):
        for gram in counts[m + 1]:
            counts[m][gram[1:]] += 1
    cut = {}
    for m in counts:
        n = Counter(counts[m].values())
        cut[m] = kneser_ney.discounts(n[1], n[2], n[3], n[4])
    context = {m: defaultdict(lambda: [0, 0, 0, 0]) for m in counts}
    for m in counts:
        for gram, k in counts[m].items():
            context[m][gram[:-1]][0] += k
            context[m][gram[:-1]][min(k, 3)] += 1
    out = []
    total = sum(raw.values())
    for words in map(tokens, texts):
        line, score, base = ["<s>"] * (order - 1) + words + ["</s>"], 0.0, 0.0
        for p in range(order - 1, len(line)):
            chance = 1 / (len(raw) + 1)
            for m in range(1, order + 1):
                gram = tuple(line[p - m + 1 : p + 1])
                seen = context[m].get(gram[:-1])
                if seen:
                    k = counts[m].get(gram, 0)
                    less = cut[m][min(k, 3) - 1] if k else 0
                    left = sum(seen[i] * cut[m][i - 1] for i in (1, 2, 3))
                    chance = max(k - less, 0) / seen[0] + left / seen[0] * chance
            score += math.log10(chance)
            base += math.log10((raw[line[p]] + 1) / (total + len(raw) + 1))
        known = sum(raw[w] > 0 for w in [*words, "</s>"])
        out.append((score, base, known))
    return out, total


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in docs}
    want, total = brute(2, [r.text for r in docs if not held[r.doc_id]], [r.text for r in docs])
    got = {r.doc_id: r for r in queries()["op1_kneser_ney"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for r, (score, base, known) in zip(docs, want, strict=True):
        g = got[r.doc_id]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (held[r.doc_id], len(tokens(r.text)) + 1, known, total)
        assert g.score == pytest.approx(score, rel=1e-9) and g.base_score == pytest.approx(base, rel=1e-9)


@pytest.mark.parametrize("order", [1, 3])
def test_other_orders_and_small_chunks(spark, table, order, odd_pairs):
    pairs = [(i, t) for i, t in odd_pairs if len(t or "") < 1000] + [(20 + i, "a b a b c a b") for i in range(5)]
    model = kneser_ney.train(table(pairs), order=order, chunk=50)
    want, total = brute(order, [t for _, t in pairs], [t for _, t in pairs])
    assert model.tokens == total
    got = kneser_ney.scored(table(pairs), model, ["doc_id"]).collect()
    assert sorted(round(r.score, 6) for r in got) == sorted(round(w[0], 6) for w in want)


def test_probabilities_of_a_context_sum_to_one(spark, table):
    model = kneser_ney.train(table([(i, t) for i, t in enumerate(["a b c", "a b d", "b a", "c c a b"])]), order=3)
    files = kneser_ney._Files(model.folder)
    words = {w: kneser_ney.word_of(w) for w in "abcd"} | {"?": np.uint64(12345), ".": kneser_ney.END}
    for before in (("a", "b"), ("c", "c"), ("d", "d"), ("b", "c")):
        total = 0.0
        for last in words:
            stream = np.array([words[w] for w in (*before, last)], np.uint64)
            total += kneser_ney.probabilities(stream, np.array([2]), model, files)[0]
        assert total == pytest.approx(1)


def test_odd_rows_and_empty_tables(spark, table, odd_pairs):
    model = kneser_ney.train(table(odd_pairs), order=2)
    out = kneser_ney.scored(table(odd_pairs), model, ["doc_id"]).collect()
    assert len(out) == len(odd_pairs) and all(r.n_known == r.n_tokens for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (3, 4, 5)} == {1}
    nothing = kneser_ney.train(table([]), order=2)
    assert kneser_ney.scored(table([]), nothing, ["doc_id"]).count() == 0
    (r,) = kneser_ney.scored(table([(1, "a b")]), nothing, ["doc_id"]).collect()
    assert (r.n_tokens, r.n_known, r.base_score, r.score) == (3, 0, 0.0, 0.0)


def test_memory_maps_need_a_mounted_folder():
    assert kneser_ney.local_path("file:///a/b%20c") == "/a/b c"
    with pytest.raises(ValueError, match="mounted"):
        kneser_ney.local_path("s3a://bucket/x")


def test_trigram_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in docs}
    want, total = brute(3, [r.text for r in docs if not held[r.doc_id]], [r.text for r in docs])
    got = {r.doc_id: r for r in queries()["op1_kneser_ney_trigram"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for r, (score, base, known) in zip(docs, want, strict=True):
        g = got[r.doc_id]
        assert (g.held_out, g.train_tokens, g.n_known) == (held[r.doc_id], total, known)
        assert (g.score, g.base_score) == pytest.approx((score, base))
