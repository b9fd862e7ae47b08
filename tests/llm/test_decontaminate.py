"""Benchmark overlaps against every diagonal compared word by word."""

import random
from itertools import combinations

import numpy as np

from tradewind.llm import decontaminate
from tradewind.llm.queries import queries

from .conftest import SMALL, prose


def segment(equal):
    best, first, score, start = (0, 0, 0), 0, 0, 0
    for i, e in enumerate(equal):
        if score <= 0:
            score, start = 0, i
        score += 1 if e else decontaminate.MISS
        if score > best[0]:
            best = (score, start, i + 1)
    _, first, last = best
    return first, last - first, sum(equal[first:last])


def brute(docs, items):
    """(doc, item) pairs with an overlap, over all diagonals."""
    out = set()
    for doc, text in docs:
        words = (text or "").lower().split()
        for item, passage in items:
            own = (passage or "").lower().split()
            if len(own) < 12:
                continue
            for d in range(1 - len(own), len(words)):
                low, high = max(0, -d), min(len(own), len(words) - d)
                _, _, equal = segment([own[k] == words[k + d] for k in range(low, high)])
                if equal >= min(decontaminate.LEAST, len(own) - 2):
                    out.add((doc, item))
    return out


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    short = [(i, t) for i, t in docs if len(t or "") < 4000]
    got = {(r.doc_id, r.item_id) for r in queries()["op9_benchmark_decontamination"](spark, SMALL).collect()}
    inside = {i for i, _ in short}
    assert {x for x in got if x[0] in inside} == brute(short, items) and got


def test_substitutions_are_tolerated(spark, table):
    pick = random.Random(4)
    items = [(k, prose(100 + k, 40)) for k in range(30)]
    pairs = []
    for k, text in items:
        words = text.split()
        for at in pick.sample(range(40), 3):
            words[at] = f"changed{at}"
        pairs.append((k, prose(500 + k, 30) + " " + " ".join(words).upper() + " " + prose(900 + k, 30)))
    pairs += [(1000 + k, prose(2000 + k, 100)) for k in range(30)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.overlaps(table(pairs), benchmark, ["doc_id"]).collect()
    assert {r.doc_id for r in out} == set(range(30)) and all(r.doc_id == r.item_id for r in out)
    best = {}
    for r in out:
        best[r.doc_id] = max(best.get(r.doc_id, (0,)), (r.n_equal, r.text_start - r.item_start))
    assert all(d == 30 for _, d in best.values())


def test_odd_rows_and_items(spark, table, odd_pairs):
    passage = prose(1, 60)
    items = [(5, passage), (4, passage), (None, passage), (6, None), (7, ""), (8, "too short an item"), (None, prose(2, 40))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    pairs = [*odd_pairs, (40, passage + " x " + passage)]
    out = decontaminate.overlaps(table(pairs), benchmark, ["doc_id"]).collect()
    # Equal items are one; rows stay apart though their ids are equal or null.
    assert sorted((repr(r.doc_id), r.item_id, r.n_words) for r in out if r.item_id) == sorted(
        [("1", 4, 60), ("2", 4, 60), ("2", 4, 60), ("None", 4, 60), ("None", 4, 60), ("8", 4, 60), ("40", 4, 60), ("40", 4, 60)]
    )
    assert sorted(r.doc_id for r in out if r.item_id is None) == [8, 12]
    assert {r.text_start for r in out if r.doc_id == 40} == {0, 61}
    assert decontaminate.overlaps(table([]), benchmark, ["doc_id"]).count() == 0
    assert decontaminate.overlaps(table(pairs), benchmark.limit(0), ["doc_id"]).count() == 0
    assert {r.doc_id for r in decontaminate.contaminated(table(pairs), benchmark, ["doc_id"]).collect()} == {1, 2, None, 8, 12, 40}


def test_long_texts_and_far_hits(spark, table):
    item = prose(77, 50)
    text = " ".join([prose(1, 60_000, 50_000), item, prose(2, 60_000, 50_000), item, prose(3, 60_000, 50_000)])
    out = decontaminate.overlaps(table([(1, text)]), spark.createDataFrame([(9, item)], "item_id long, text string"), ["doc_id"]).collect()
    assert sorted((r.text_start, r.n_words) for r in out) == [(60_000, 50), (120_050, 50)]


def test_every_accepted_pattern_has_a_seed():
    for n in (12, 13, 14, 20, 24):
        for k in range(5):
            for changed in combinations(range(n), k):
                equal = np.ones(n, bool)
                equal[list(changed)] = False
                first, length, same = decontaminate.best_segment(equal)
                if same >= min(decontaminate.LEAST, n - 2):
                    hits = [equal[first + i] or m != "1" for mask in decontaminate.MASKS for i, m in enumerate(mask)]
                    assert any(all(hits[i : i + 10]) for i in range(0, len(hits), 10)), (n, changed)


def test_periodic_changes_and_short_items(spark, table):
    items = [(k, prose(300 + k, 40)) for k in range(6)] + [(10 + n, prose(400 + n, n, 90_000)) for n in range(1, 12)]
    pairs = []
    for k, text in items[:6]:
        words = [f"other{i}" if i % 6 == k else w for i, w in enumerate(text.split())]
        pairs.append((k, prose(500 + k, 30, 70_000) + " " + " ".join(words) + " " + prose(600 + k, 30, 70_000)))
    for item, text in items[6:]:
        pairs.append((item, prose(700 + item, 20, 3) + "\n" + text.upper() + " " + prose(800 + item, 20, 3)))
    pairs += [(100 + n, " ".join([*prose(400 + n, n, 90_000).split()[:-1], "different"])) for n in range(1, 12)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.overlaps(table(pairs), benchmark, ["doc_id"]).collect()
    assert sorted({(r.doc_id, r.item_id) for r in out}) == [(i, i) for i, _ in items]
    assert all(r.n_equal == r.n_words == r.item_id - 10 and r.text_start == 20 for r in out if r.item_id > 10)
