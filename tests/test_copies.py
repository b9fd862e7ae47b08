"""Rows that stand many times: counted, copied last, and weighed in checks."""

from pyspark.sql import functions as F

import suite
from conftest import SMALL, rows
from suite import report_queries
from suite.entities import Entities
from suite.marts_queries import COPIES, d7, t6
from tradewind.operators import quality, staging
from tradewind.operators.joins import repeated
from tradewind.session import keep


def test_rows_come_as_often_as_they_say(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "a", 3), (2, "a", 2), (3, "b", 10_000)], "k int, v string, n bigint")
    for spread in (False, True):
        got = repeated(df, "n", spread).groupBy("k", "v").count()
        assert rows(got) == [(1, None, 1), (2, "a", 5), (3, "b", 10_000)]


def test_customers_of_a_crowded_prefix_are_made_by_many_tasks(spark):
    """Few rows with many places each: none of them is left to the one task that reads them."""
    raw = spark.range(200, numPartitions=1).select(
        F.col("id").alias("customer_id"), F.lit("u").alias("customer_unique_id"), F.lit("C").alias("customer_city"),
        F.lit("SP").alias("customer_state"), (F.col("id") % 2).cast("string").alias("customer_zip_code_prefix"),
    )
    geo = spark.range(600, numPartitions=1).select(
        F.lit("1").alias("geolocation_zip_code_prefix"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("p"), F.col("id") % 3)).alias("geolocation_city"),
        F.lit("BR").alias("geolocation_state"),
    )
    got = staging.strict_customers(raw, geo, all_places=True)
    per_task = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) >= 6 and max(r[1] for r in per_task) < 60_100 / 2
    assert rows(got.groupBy("geolocation_city").agg(F.count("*"), F.countDistinct("customer_id"))) == [
        ("p1", 20_000, 100), ("p2", 20_000, 100), (None, 20_100, 200)
    ]
    counted = staging.strict_customers(raw, geo, all_places=True, copies="n")
    assert counted.count() == 400 and rows(repeated(counted, "n")) == rows(got)


CHECKS = [
    quality.Check("facts", "k", "unique"),
    quality.Check("facts", "k", "not_null"),
    quality.Check("facts", "v", "accepted_values", "error", ("a",)),
    quality.Check("facts", "v", "expression", "warn", "v <> 'b'"),
    quality.Check("facts", "k", "relationships", "warn", ("parents", "k")),
    quality.Check("parents", "k", "unique"),
]


def test_checks_of_counted_rows_equal_those_of_all_rows(spark):
    facts = spark.createDataFrame([(1, "a", 1), (2, "b", 3), (3, "b", 1), (3, None, 2), (None, "a", 5), (4, "c", 1)], "k int, v string, n bigint")
    parents = spark.createDataFrame([(1,), (3,)], "k int")
    want = quality.run_checks({"facts": repeated(facts, "n"), "parents": parents}, CHECKS)
    got = quality.run_checks({"facts": facts, "parents": parents}, CHECKS, {"facts": "n"})
    assert rows(got) == rows(want) and [r.failures for r in got.orderBy("check_name").collect()] != [0] * len(CHECKS)


def test_facts_are_stored_without_their_copies(spark, monkeypatch):
    """The places of a prefix multiply customers and orders; what is written does not grow with them."""
    e = Entities(spark, SMALL)
    everywhere = e.raw_geo.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("_")
    once, often = (d7(e, t).count() for t in (t6(e, COPIES), staging.strict_customers(e.raw_customers, everywhere, True, COPIES)))
    assert once == often and repeated(d7(e), COPIES).count() > once
    stored = {}
    monkeypatch.setattr(report_queries, "keep", lambda df, label: stored.setdefault(label, keep(df, label)))
    suite.queries()["q8_star_checks"](spark, SMALL).collect()
    assert stored["facts"].count() == once < repeated(d7(e), COPIES).count()


def test_facts_meet_customers_and_products_before_they_multiply(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    e = Entities(spark, SMALL)
    plan = d7(e)._jdf.queryExecution().optimizedPlan().toString()
    # The outermost joins are those on the order.
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert len(joins) >= 6 and all("order_id" in line for line in joins[:3])
