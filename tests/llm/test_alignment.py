"""Token alignment: pointer jumping and the whole query against plain loops."""

import bisect
import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tradewind.llm import alignment
from tradewind.llm.queries import queries

PATHS = tuple(public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def ends(sizes):
    return list(itertools.accumulate(sizes))


def plain_groups(a_sizes, b_sizes):
    """Groups cut where both end."""
    cuts = sorted(set(ends(a_sizes)) & set(ends(b_sizes)))
    return [bisect.bisect_left(cuts, e) for e in ends(a_sizes)], [bisect.bisect_left(cuts, e) for e in ends(b_sizes)]


@pytest.fixture(scope="module")
def tokens():
    """Whole texts under both tokenizers, without cutting them first."""
    known = alignment.Aligner(*PATHS)

    def of(text):
        if not text:
            return [], []
        a = known.a.encode(" " + text, add_special_tokens=False).ids
        b = known.b.encode(text)
        if not b"".join(known.a_bytes[i] for i in a) == b"".join(known.b_bytes[i] for i in b) == (" " + text).encode():
            return [], []
        return a, b

    of.known = known
    return of


def plain_rows(rows, tokens):
    """The query's result by loops over documents, groups and links."""
    made, holds = [], Counter()
    for i, text in rows:
        a, b = tokens(text)
        of_a, of_b = plain_groups([len(tokens.known.a_bytes[t]) for t in a], [len(tokens.known.b_bytes[t]) for t in b])
        groups = defaultdict(lambda: ([], []))
        for side, ids, own in ((0, a, of_a), (1, b, of_b)):
            for t, g in zip(ids, own, strict=True):
                groups[g][side].append(t)
        links = [p for g in sorted(groups) for p in itertools.product(*groups[g])]
        holds.update(set(links))
        text = ";".join("|".join(",".join(map(str, s)) for s in groups[g]) for g in sorted(groups))
        made.append((i, len(a), len(b), len(groups), links, text))
    best = defaultdict(int)
    for (a, _), n in holds.items():
        best[a] = max(best[a], n)
    return sorted(
        (
            (i, n_a, n_b, n, len(links), sum(holds[p] == best[p[0]] for p in links), sum(holds[p] for p in links), t and hashlib.sha256(t.encode()).hexdigest())
            for i, n_a, n_b, n, links, t in made
        ),
        key=repr,
    )


def test_pointer_jumping_finds_the_common_ends():
    pick = random.Random(4)
    for n in [1, 2, 3, 7, 40, 300] * 20:
        cuts = [sorted({n, *pick.sample(range(1, n + 1), pick.randrange(0, n))}) for _ in range(2)]
        a, b = (np.diff([0, *c]) for c in cuts)
        of_a, of_b, many = alignment.groups(a, b)
        assert (of_a.tolist(), of_b.tolist()) == plain_groups(a.tolist(), b.tolist())
        assert many == len(set(cuts[0]) & set(cuts[1]))
    # One long component: all ends but the last differ, so pointers must jump far.
    a, b = np.full(1 << 16, 2), np.array([1, *[2] * ((1 << 16) - 1), 1])
    of_a, of_b, many = alignment.groups(a, b)
    assert many == 1 and not of_a.any() and not of_b.any()


TEXTS = [
    "plain words, don't they?  two  spaces\tand tabs\n\nlines \n", " leading and trailing ", "x", " ", "\n", "   ", "a ",
    "naïve café — 東京タワー 😀👩‍👩‍👧 ½ ﬁ", "<|endoftext|> <s> </s> <0x41> <unk>", "a▁b", "  odd spaces \u0085 x\u0085 y",
    "0123456789 3.14159 1e-7", "ab" * 400, "\x00\x01 \x1c \x1d\x7f", "é combining ́", "don't  'll  's", "\x1f b\x1e c",
]


def test_cutting_a_text_changes_no_token(tokens):
    known = tokens.known
    assert known.cut
    pick = random.Random(9)
    chars = "ab'sT .,\n\t\ré世1!\x1f\u3000"
    texts = TEXTS + ["".join(pick.choices(chars, weights=[4, 4, 1, 1, 1, 9, *[1] * (len(chars) - 6)], k=60)) for _ in range(300)]
    for text in texts:
        pieces = known.pieces(text)
        assert "".join(pieces) == " " + text
        a = [i for p in pieces for i in known.a.encode(p, add_special_tokens=False).ids]
        b = [i for p in pieces for i in known.b.encode(p[1:])]
        assert a == known.a.encode(" " + text, add_special_tokens=False).ids, repr(text)
        assert b == known.b.encode(text), repr(text)


def test_query_equals_plain_loops(spark, tokens):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in queries()["op13_token_alignment"](spark, folder).collect()), key=repr)
    assert got == plain_rows(docs, tokens) and len(got) == len(docs)


@pytest.mark.parametrize("hot", [0, 3])
def test_odd_texts_and_any_number_of_hot_pairs(spark, table, tokens, odd_pairs, hot):
    rows = odd_pairs + [(100 + i, t) for i, t in enumerate(TEXTS)]
    found = alignment.linked(table(rows), ["doc_id"], *PATHS, hot_pairs=hot)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == plain_rows(rows, tokens)
    assert alignment.linked(table([]), ["doc_id"], *PATHS, hot_pairs=hot).count() == 0


def test_small_memories_give_the_same(monkeypatch, tokens):
    monkeypatch.setattr(alignment, "MOST_PIECES", 3)
    known = alignment.Aligner(*PATHS)
    for text in TEXTS * 2:
        mine, whole = known.found([text, None, text]), tokens.known.found([text, None, text])
        assert mine["written"] == whole["written"] and mine["written"][1] == ""
        assert all(np.array_equal(mine[k], whole[k]) for k in ("sizes", "pairs", "links", "per_text"))


def test_groups_as_text(table):
    (r,) = alignment.aligned(table([(1, "Hello world")]), ["doc_id"], *PATHS).collect()
    assert r.n_groups == len(r.groups.split(";")) and len(r.pairs) == len(r.links) and r.n_links == sum(r.links)
