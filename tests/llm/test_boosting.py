"""Boosted trees: known functions, traversal against plain recursion, held-out accuracy."""

import zlib

import numpy as np
import pytest

from tradewind.llm import boosting
from tradewind.llm.queries import queries


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    out = queries()["op10_quality_trees"](spark, folder).collect()
    assert len(out) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in out[:200]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3)
    held = [r for r in out if r.held_out and r.doc_id in labels]
    right = [r.predicted == labels[r.doc_id] for r in held]
    assert len(held) > 300 and sum(right) >= 0.97 * len(right)


def walk(model, row):
    odds = model.start
    for feature, limit, leaf in zip(model.feature, model.limit, model.leaf, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > limit[node] else 1)
        odds += leaf[node - len(feature)]
    return 1 / (1 + np.exp(-odds))


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = boosting.fit(x[:3000], y[:3000])
    scores = model.scores(x[3000:])
    assert ((scores > 0.5) == (y[3000:] > 0.5)).mean() > 0.97
    assert scores[:50] == pytest.approx([walk(model, r) for r in x[3000:3050]])


def test_no_rows_and_one_label():
    x = np.zeros((4, 3), np.float32)
    assert boosting.fit(x[:0], np.zeros(0)).scores(x).tolist() == [0.5] * 4
    assert boosting.fit(x, np.ones(4)).scores(x) == pytest.approx([0.9] * 4)
    # Nothing to split on: all rows go one way.
    assert len(set(boosting.fit(x, np.array([0, 1, 1, 1.0])).scores(x))) == 1


def test_statistics_of_known_texts(table):
    text = "Ab ab ab! x|y 12\nab é."
    (r,) = boosting.featured(table([(1, text)]), ["doc_id"]).collect()
    got = dict(zip(boosting.FEATURES, r.features, strict=True))
    size = len(text.encode())
    assert got["share_upper"] == pytest.approx(1 / size) and got["share_digit"] == pytest.approx(2 / size)
    assert got["share_pipe"] == got["share_shout"] == got["share_newline"] == got["share_lead"] == pytest.approx(1 / size)
    assert got["log_words"] == pytest.approx(np.log1p(7)) and got["doubled_words"] == pytest.approx(1 / 7)
    assert got["commonest_word"] == pytest.approx(3 / 7) and got["words_per_stop"] == pytest.approx(7 / 2)


def test_odd_rows(spark, table, odd_pairs):
    found = boosting.featured(table(odd_pairs), ["doc_id"])
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None), (99, 1), (8, 0)], "doc_id long, label int")
    model = boosting.train(found, labels)
    out = boosting.scored(found, model, ["doc_id"]).collect()
    assert len(out) == len(odd_pairs) and all(0 <= r.score <= 1 for r in out)
    empty = boosting.featured(table([]), ["doc_id"])
    assert boosting.scored(empty, boosting.train(empty, labels), ["doc_id"]).count() == 0
    assert all(not any(r.features) for r in found.collect() if r.doc_id in (3, 4, 5))
