"""Checks, verdict, freshness."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradewind.operators import quality as Q
from tradewind.operators.quality import Check
from tradewind.session import scratch_path


@pytest.fixture(scope="module")
def child(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0), (1, "b", -1.0), (2, None, None), (None, "z", 0.0), (3, "a", 3.0)],
        "id int, k string, v double",
    )


@pytest.fixture(scope="module")
def parent(spark):
    return spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")


def test_single_checks(child, parent):
    assert rows(Q.unique(child, "id")) == [(1, 2)]
    assert rows(Q.unique(child, ["id", "k"])) == []
    assert Q.not_null(child, "k").count() == 1
    assert rows(Q.accepted_values(child, "k", ["a", "b"]).select("k")) == [("z",)]
    assert rows(Q.relationships(child, "k", parent, "k").select("k")) == [("z",)]
    # An unknown outcome is no failure.
    assert rows(Q.expression_is_true(child, "v >= 0").select("v")) == [(-1.0,)]
    assert rows(Q.in_range(child, "v", 0, 4).select("v")) == [(-1.0,), (5.0,)]
    assert rows(Q.valid_numeric(child, "v")) == [("Data type violation detected", 1, 5)]
    assert rows(Q.valid_numeric(child.where("v IS NOT NULL"), "v")) == []


CHECKS = [
    Check("child", "id", "unique", "error"),
    Check("child", "id", "not_null", "warn"),
    Check("child", "k", "relationships", "warn", ("parent", "k")),
    Check("child", "k", "accepted_values", "warn", ("a", "b", "z")),
    Check("child", "v", "expression", "error", "v < 100"),
    Check("child", "v", "range", "warn", (0, 4)),
    Check("child", "id", "unique", "warn", ["id", "k"]),
]


def test_run_and_gate(child, parent):
    tables = {"child": child, "parent": parent}
    results = Q.run_checks(tables, CHECKS)
    got = [(r.column_name, r.severity, r.failures, r.outcome) for r in results.collect()]
    assert sorted(got) == sorted(
        [
            ("id", "error", 1, "ERROR"), ("id", "warn", 1, "WARN"), ("k", "warn", 1, "WARN"),
            ("k", "warn", 0, "PASS"), ("v", "error", 0, "PASS"), ("v", "warn", 2, "WARN"),
            ("id", "warn", 0, "PASS"),
        ]
    )
    assert tuple(Q.gate(results).first()) == (3, 3, 1, 7, "FAILED")
    assert Q.gate(results.where("severity = 'warn'")).first().status == "WARNING"
    assert Q.gate(results.where("outcome = 'PASS'")).first().status == "SUCCESS"


def test_fused_counts_equal_the_single_checks(child, parent):
    results = {(r.check_name): r.failures for r in Q.run_checks({"child": child, "parent": parent}, CHECKS).collect()}
    assert results[CHECKS[0].name] in (0, 1)
    assert results[CHECKS[2].name] == Q.relationships(child, "k", parent, "k").count()
    assert results[CHECKS[5].name] == Q.in_range(child, "v", 0, 4).count()


@pytest.mark.parametrize("loaded, hours, stale", [("2024-01-02 00:00:00", 24, False), ("2024-01-01 23:00:00", 25, True)])
def test_freshness(spark, loaded, hours, stale):
    df = spark.createDataFrame([(loaded,), ("2020-01-01 00:00:00",)], "t string").selectExpr("timestamp(t) t")
    got = Q.freshness(df, "t", F.lit("2024-01-03 00:00:00").cast("timestamp")).first()
    assert (got.hours_old, got.is_stale) == (hours, stale)


def test_recency(spark):
    old, new, none = (scratch_path(spark, n) for n in ("old", "new", "none"))
    spark.range(1).write.parquet(old)
    spark.range(0).where("false").write.json(none)  # a folder without Parquet files
    spark.range(1).write.parquet(new)
    now = F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(minutes=30)).cast("timestamp")
    got = Q.recency(spark, {"a_old": old, "b_new": new, "c_none": none}, now).first()
    assert (got.table_name, got.recently_updated) == ("b_new", False) and 29 <= got.minutes_since_update <= 30
    assert Q.recency(spark, {"b_new": new}, now, minutes=60).first().recently_updated


def test_report(spark, child, parent):
    counts = spark.createDataFrame([("a", 2), ("b", 3), ("total", 5)], "table_name string, row_count long")
    results = Q.run_checks({"child": child, "parent": parent}, CHECKS[1:4])
    assert tuple(Q.run_report(counts, results).first()) == (2, 5, "WARNING")
