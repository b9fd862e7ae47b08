"""Hard negatives: intervals hold, results equal brute force and SQL, odd vectors."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import negatives
from tradewind.llm.queries import ORACLES, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=10, shares=(30, 90)):
    """Plain loops over (vec_id, embedding, label); anchors are ids divisible by 100."""
    known = []
    width = max((len(e) for _, e, _ in rows if e is not None), default=0)
    for i, e, label in rows:
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        known.append((i, [math.floor(256 * float(np.float32(x))) for x in e] + [0] * (width - len(e)), label))
    last = lambda s, i: (-s, i is None, i or 0)
    out = []
    for a, v, own in known:
        if a is None or a % 100:
            continue
        scored = [(sum(p * q for p, q in zip(v, w, strict=True)), i, label) for i, w, label in known if i != a]
        same = sorted([(s, i) for s, i, label in scored if label == own], key=lambda x: last(*x))[:positives]
        for ps, p in same:
            fits = [(s, i) for s, i, label in scored if label != own and shares[0] * ps <= 100 * s <= shares[1] * ps]
            for rank, (s, i) in enumerate(sorted(fits, key=lambda x: last(*x))[:negatives], 1):
                out.append((a, p, rank, i, ps, s))
    return sorted(out, key=repr)


def found(spark, rows, schema=SCHEMA, **more):
    df = spark.createDataFrame(rows, schema)
    out = negatives.hard_negatives(df, F.pmod("vec_id", F.lit(100)) == 0, **more)
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("bits", [1, 4])
def test_intervals_hold_every_product(monkeypatch, bits):
    monkeypatch.setattr(negatives, "BITS", bits)
    negatives.frame.cache_clear()
    rng = np.random.default_rng(3)
    v = negatives.whole(rng.normal(size=(300, 24)) * rng.choice([0.0, 0.01, 1, 50], size=(300, 1)))
    v[7] = v[6]
    turn = negatives.frame(24, 11)
    assert np.allclose(turn.T @ turn, np.eye(24))
    signs, *numbers = negatives.codes(v, turn)
    low, high = negatives.Query(v, turn).intervals(slice(0, 300), signs, *numbers)
    exact = v @ v.T
    assert (low <= exact).all() and (exact <= high).all()
    # They tell something: on the average much narrower than the two norms alone allow.
    norms = np.sqrt(np.outer(numbers[2], numbers[2]))
    assert ((high - low).sum() / (2 * norms).sum()) < (0.8 if bits == 1 else 0.45)
    negatives.frame.cache_clear()


def test_equals_brute_force_over_several_groups(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 60)
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(4, 12))
    rows = []
    for i in range(700):
        # A hot label, and a vector that a third of all rows share.
        label = 1 if rng.random() < 0.5 else int(rng.integers(0, 4))
        e = centre[0] if rng.random() < 0.33 else centre[rng.integers(0, 4)] + rng.normal(size=12) * 0.4
        rows.append((i, [float(np.float32(x)) for x in e], label))
    expected = brute(rows)
    assert len(expected) > 100 and found(spark, rows) == expected
    assert found(spark, rows, positives=2, negatives=3, shares=(0, 100)) == brute(rows, 2, 3, (0, 100))


def test_query_equals_sql_and_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    name = "op11_hard_negatives"
    out = queries()[name](spark, folder)
    got = sorted(tuple(r) for r in out.collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    assert got == sorted(con.execute(ORACLES[name]).fetchall()) and got
    rows = [
        (r.vec_id, list(r.embedding), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
        for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ]
    assert got == sorted(brute(rows))


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.0], 2), (3, [0.5, 0.0], 2), (None, [0.5, 0.0], 2),
        (4, None, 2), (5, [0.5, None], 2), (6, [0.5, nan], 2), (8, [inf, 0.0], 2), (9, [0.5, 0.0], None),
        (10, [0.5], 2), (11, [], 2), (100, [0.0, 0.0], 3), (200, [-1.0, 0.0], 4), (201, [0.1, 0.0], 4),
        (300, [], 5), (301, [0.2, 0.2], 5), (12, [0.5, 0.0], 2), (12, [0.5, 0.0], 2), (None, [0.9, 0.1], 1),
    ]
    expected = brute(rows)
    assert found(spark, rows) == expected and any(r[3] is None for r in expected) and any(r[1] is None for r in expected)
    # A negative best score leaves no room between its shares; a label of its own has no positives.
    assert not [r for r in expected if r[0] in (100, 200)]


def test_empty_tables_huge_numbers_and_clashing_columns(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1)]) == []  # no anchor
    assert found(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == brute([(0, [], 1), (1, [], 1), (2, [], 2)])
    huge = [(0, [3e30, 1.0], 1), (1, [2e30, 1.0], 1), (2, [1.0, 3.0], 2), (3, [1e-30, 1.0], 2)]
    most = 2**63 - 1
    assert found(spark, huge) == []  # the positive's score is held at the end of a long
    (r,) = found(spark, [*huge[:2], (2, [1e-11, 3.0], 2), (3, [0.0, 1.0], 2)], shares=(0, 90))[:1]
    assert r[4] == most
    extra = SCHEMA + ", row string, code string, norm string, rank string, anchor string, scores string, row_group string"
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]
    assert found(spark, [(*r, *"abcdefg") for r in rows], extra) == brute(rows) != []
