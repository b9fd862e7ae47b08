import random

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use themselves.
CLASHING = "v string, bucket int, `group` string, signature string, component int, spans string, features string, start string, length string, votes string, row_print string, text_key string, shard string, n_spans int"


@pytest.fixture
def table(spark):
    """Documents from (doc_id, text), with columns whose names the operators use."""

    def make(pairs, clashing=True):
        rows = [(i, t, None, "s", None if t is None else len(t)) for i, t in pairs]
        df = spark.createDataFrame(rows, SCHEMA)
        if clashing:
            for column in CLASHING.split(", "):
                name, kind = column.rsplit(" ", 1)
                df = df.selectExpr("*", f"CAST(NULL AS {kind}) AS {name}")
        return df

    return make


def prose(seed, n, vocabulary=4000):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture
def odd_pairs():
    """Null and empty texts, null and repeated ids, equal rows, ties, and a very long text."""
    a, b = prose(1, 60), prose(2, 40)
    return [
        (1, a), (2, a), (2, a), (None, a), (None, a), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "One"),
        (8, b), (8, a + " more"), (None, None), (None, ""), (9, prose(3, 150_000, 40_000)), (10, "é" * 70_000),
        (11, "a b \u0085 ñ"), (12, b.upper()),
    ]
