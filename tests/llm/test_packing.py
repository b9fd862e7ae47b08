"""Packing: exact round trip, the cheapest cuts by exhaustive search, and gapless sequences."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tradewind.llm import packing
from tradewind.llm.queries import queries

from .conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def whole(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], np.uint32)


def test_query_round_trip(spark, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    pieces, sequences = {}, {}
    for r in queries()["op8_packing"](spark, SMALL).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for doc, text in docs.items():
        ids, at = whole(tokenizer, text), 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert zlib.crc32(ids[r.start : at].tobytes()) == r.ids_crc32
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    used = sum(n for parts in sequences.values() for _, n in parts)
    assert len(sequences) <= -(-used // 4096) * 1.02 + 1


def cost_of(cuts, at, penalty, length):
    of = dict(zip(at, penalty, strict=True)) | {at[-1]: 0}
    return sum(length - (b - a) + of[b] for a, b in zip([0, *cuts], cuts))


def cheapest(at, penalty, length):
    best = {0: 0}
    for j, p in enumerate(at):
        extra = 0 if j == len(at) - 1 else penalty[j]
        best[p] = min(best[q] + length - (p - q) + extra for q in best if p - q <= length)
    return best[at[-1]]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_cheapest(seed):
    pick = random.Random(seed)
    length = pick.choice([10, 37, 100])
    at = np.cumsum([pick.randint(1, length) for _ in range(pick.randint(1, 60))])
    penalty = np.array([pick.choice([0, 8, 256]) for _ in at])
    cuts = packing.best_cuts(at, penalty, length).tolist()
    assert cuts[-1] == at[-1] and set(cuts) <= set(at.tolist())
    assert all(b - a <= length for a, b in zip([0, *cuts], cuts))
    assert cost_of(cuts, at.tolist(), penalty.tolist(), length) == cheapest(at.tolist(), penalty.tolist(), length)


@pytest.mark.parametrize("portion", [100, 1000, 10**6])
def test_portions_lose_nothing(portion):
    pick = np.random.default_rng(1)
    docs = [np.append(pick.integers(10, 50, n), 2).astype(np.uint32) for n in pick.integers(0, 300, 80)]
    ends = np.zeros(50, bool)
    ends[10] = True
    rows = list(packing._windows(iter(docs), ends, 64, portion))
    for i, doc in enumerate(docs):
        parts = sorted((start, ids) for d, start, ids, _, _ in rows if d == i)
        assert np.concatenate([p for _, p in parts]).tolist() == doc.tolist()
    assert max(sum(len(r[2]) for r in rows if r[3] == w) for w in {r[3] for r in rows}) <= 64


def test_odd_rows(spark, table, tokenizer):
    pairs = [
        (1, None), (2, ""), (2, ""), (None, "A b."), (3, "x" * 50_000), (4, "word " * 9000), (5, "<|endoftext|> İ ﬁ é ½ don't"),
        (6, "\x1c \x85  tab\tÅ K"), (7, "no stop " * 3000),
    ]
    out = packing.packed(table(pairs), ["doc_id"], PATH).collect()
    for doc, text in pairs:
        ids = whole(tokenizer, text)
        parts = sorted((r.start, bytes(r.ids)) for r in out if r.doc_id == doc)
        parts = list(dict.fromkeys(parts))  # the repeated row gives the same pieces again
        assert b"".join(p for _, p in parts) == ids.astype("<u4").tobytes()
    assert sum(r.length for r in out if r.doc_id == 2) == 2
    assert packing.packed(table([]), ["doc_id"], PATH).count() == 0


def test_known_words_may_be_forgotten(tokenizer):
    words = packing.Words(tokenizer, most=12, recent=3)
    texts = ["a b c d e f g", "h i j", None, "a b c", "Hello, World!"]
    assert [x.tolist() for x in words.ids(pa.array(texts))] == [whole(tokenizer, t).tolist() for t in texts]
    assert [x.tolist() for x in words.ids(pa.array(texts))] == [whole(tokenizer, t).tolist() for t in texts]
