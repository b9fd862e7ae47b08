"""Sharding: the permutation as numbers and as columns, laws, and independence of the layout."""

import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.llm import shards
from tradewind.llm.queries import queries

from .conftest import SMALL


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 10**6))
def test_permutation_is_one_to_one(n, seed):
    assert sorted(shards.permuted(i, n, seed) for i in range(n)) == list(range(n))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_column_equals_numbers(spark, n):
    got = spark.range(n).select(shards.permuted_column(F.col("id"), n, 5).alias("p")).collect()
    assert [r.p for r in got] == [shards.permuted(i, n, 5) for i in range(n)]


@pytest.mark.parametrize("n", [10**9 + 7, 10**12 + 39, 2**40])
def test_large_domains_walk_little(n):
    a, b = shards.domain(n)
    assert a * b >= n and a * b - n <= 1000 and max(a, b) < 2**31
    assert len({shards.permuted(i, n, 1) for i in range(0, n, n // 500)}) == len(range(0, n, n // 500))


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    out = queries()["op4_sharding"](spark, SMALL).collect()
    assert len(out) == len(docs)
    slots = {}
    for r in out:
        raw = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    # Shard and slot follow from the row number alone.
    for i, doc in enumerate(sorted(docs)):
        p = shards.permuted(i, len(docs), 17)
        r = next(r for r in out if r.doc_id == doc)
        assert (r.shard, r.slot) == (p % 24, p // 24)


def test_plan_has_no_python(spark):
    plan = queries()["op4_sharding"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_layout_does_not_matter(spark, table, odd_pairs):
    rows = table(odd_pairs).withColumn("size", F.length("text")).drop("shard")

    def result(df):
        return sorted((repr(r.doc_id), repr(r["size"]), r.shard, r.slot) for r in shards.sharded(df, ["doc_id", "size"], 5, 3).collect())

    assert result(rows) == result(rows.repartition(7).orderBy(F.rand(1)))
    assert len(result(rows)) == len(odd_pairs)


def test_empty_table_and_equal_rows(spark, table):
    assert shards.sharded(table([]), ["doc_id"], 24).count() == 0
    out = shards.sharded(table([(1, "a")] * 100), ["doc_id"], 24).collect()
    assert sorted((r.shard, r.slot) for r in out) == sorted((p % 24, p // 24) for p in range(100))


def test_files_by_shard(spark, table, tmp_path):
    found = shards.sharded(table([(i, f"t{i}") for i in range(50)], clashing=False), ["doc_id"], 4)
    shards.write_shards(found, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and {r.shard for r in back.select("shard").collect()} == {0, 1, 2, 3}
