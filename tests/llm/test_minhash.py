"""Near duplicates against all pairs compared in full."""

import random
import re


from tradewind.llm import minhash
from tradewind.llm.components import components
from tradewind.llm.queries import queries

from .conftest import SMALL, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(pairs, percent=85):
    """Least reachable id of each row, and its set size; ids must be distinct."""
    sets = [(i, shingles(t)) for i, t in pairs]
    above = {i: i for i, _ in sets}

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b) and top(i) != top(j):
                low, high = sorted((top(i), top(j)))
                above[high] = low
    return {i: (len(s), top(i), top(i) == i) for i, s in sets}


def found(df):
    out = minhash.one_per_group(minhash.near_duplicates(df, ["doc_id"]))
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.collect()}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries()["op5_minhash_near_dedup"](spark, SMALL).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_chains_of_edits_and_large_groups(table, monkeypatch):
    """Groups larger than a block, whose members differ from each other more than from a neighbour."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 8)
    pick = random.Random(5)
    pairs, words = [], prose(9, 80).split()
    for i in range(120):
        pairs.append((1000 - i, " ".join(words)))
        words[pick.randrange(80)] = f"x{i}"
    pairs += [(2000 + i, prose(50 + i, 30)) for i in range(40)]
    assert found(table(pairs)) == brute(pairs)


def test_odd_rows(table, odd_pairs):
    out = minhash.one_per_group(minhash.near_duplicates(table(odd_pairs), ["doc_id"])).collect()
    assert len(out) == len(odd_pairs)
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by_id[1] == [(56, 1, True)] and by_id[2] == [(56, 1, False)] * 2
    # Rows without an id join groups and are never the one that stays there.
    assert sorted(by_id[None], key=repr) == sorted([(56, 1, False)] * 2 + [(0, None, True)] * 2, key=repr)
    assert [by_id[i] for i in (3, 4, 5)] == [[(0, i, True)] for i in (3, 4, 5)]
    assert by_id[6] == [(1, 6, True)] and by_id[7] == [(1, 6, False)]
    assert by_id[12] == [(36, 8, False)] and (36, 8, True) in by_id[8] and (57, 1, False) in by_id[8]
    assert by_id[9][0][1:] == (9, True) and by_id[10] == [(1, 10, True)]


def test_empty_table(table):
    assert minhash.one_per_group(minhash.near_duplicates(table([]), ["doc_id"])).count() == 0


def test_components_of_long_chains_loops_and_nulls(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (600, 601), (601, 600), (None, 7)]
    got = {r.v: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {600: 600, 601: 600}


def test_signature_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    shared = rng.integers(0, 2**63, 800).astype(np.uint64)
    a = np.unique(np.concatenate([shared, rng.integers(0, 2**63, 200).astype(np.uint64)]))
    b = np.unique(np.concatenate([shared, rng.integers(0, 2**63, 200).astype(np.uint64)]))
    one, two = minhash.signatures(np.concatenate([a, b]), np.array([len(a), 0, len(b)]), 2048)
    agree = (one == two).mean()
    assert abs(agree - 800 / 1200) < 0.05
