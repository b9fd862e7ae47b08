"""The pipeline against its stages done by hand, and odd tables through every stage."""


import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tradewind.session import keep

from .conftest import SMALL
from .test_decontaminate import brute as overlaps
from .test_minhash import brute as near
from .test_packing import tokenizer, whole  # noqa: F401
from .test_secrets import brute as spans


PROSE = (
    "The old house stood by the river. Nobody had lived there for years, and the garden had grown wild. On summer evenings "
    "children crept through the gate to pick plums. They told each other stories about the lamp in the upper window."
)


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "secret_scan", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_stages_by_hand(spark, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    left = keep(corpus_pipeline.quality_rules(spark, docs, SMALL), "left")  # its own test has the verdicts
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    texts = {i: texts[i] for i, (_, _, kept) in near(list(texts.items()), 80).items() if kept}
    leaked = {d for d, _ in overlaps([(i, t) for i, t in texts.items() if len(t) < 4000], items)}
    out = {}
    for r in corpus_pipeline.run(spark, SMALL).collect():
        out.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    long = {i for i in texts if len(texts[i]) >= 4000}
    assert set(out) - long == set(texts) - leaked - long and set(out) <= set(texts)
    for doc, parts in out.items():
        text, clean, at = texts[doc], "", 0
        for kind, start, end in spans(text):
            if end > at:
                clean += text[at:start] + f"[{kind}]" if start >= at else ""
                at = end
        ids = whole(tokenizer, clean + text[at:])
        assert b"".join(p for _, p in sorted(parts)) == ids.astype("<u4").tobytes()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_odd_tables(spark, table, odd_pairs, name, stage):
    pairs = [*odd_pairs, (50, "token=abcdefgh " * 3 + "and more words that follow on here")]
    if name == "quality_rules":
        pairs += [(60, PROSE), (61, PROSE.replace(" ", "\n", 9)), (62, PROSE.upper().replace(" ", "!! "))]
    docs = keep(table(pairs), "odd")
    out = stage(spark, docs, SMALL)
    assert out.columns == docs.columns and out.schema == docs.schema
    rows = out.collect()
    if name == "quality_rules":
        # Words with digits and without a sentence are no prose.
        assert {r.doc_id for r in rows} == {60, 61}
    elif name == "near_dedup":
        # Equal rows are one; so are copies, and the least id stays. Empty texts are left alone.
        assert sorted(repr(r.doc_id) for r in rows) == sorted(map(repr, [1, 3, 4, 5, 6, 8, None, None, 9, 10, 11, 50]))
    elif name == "decontamination":
        assert len(rows) == len(pairs)
    else:
        assert len(rows) == len(pairs)
        (r,) = [r for r in rows if r.doc_id == 50]
        assert r.text == "[assign] " * 3 + "and more words that follow on here" and r.n_chars == len(r.text)
    assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_columns_in_another_order_and_none_but_two(spark, table):
    docs = table([(1, "secret=abcdefgh " + "word " * 9)]).select("v", "text", "doc_id").withColumn("a.b `c`", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns

