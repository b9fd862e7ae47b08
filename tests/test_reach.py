"""Distinct counts that add up: exact below a stated size, bounded above."""

from pyspark.sql import functions as F

from conftest import SMALL, rows
from suite.entities import Entities
from suite.reach_queries import stored
from tradewind.operators.distinct import distinct_count, distinct_sketch, merged
from tradewind.plans.reach import reach


def test_exact_up_to_its_size_however_it_is_merged(spark):
    n = 2**12
    df = spark.range(5 * n, numPartitions=6).select((F.col("id") % n).alias("k"), (F.col("id") % 37).alias("g"), (F.col("id") % 3).alias("h"))
    groups = df.groupBy("g", "h").agg(distinct_sketch(F.col("k"), 12).alias("s"))
    by_h = groups.groupBy("h").agg(merged(F.col("s"), 12).alias("s"))
    assert rows(by_h.select("h", distinct_count(F.col("s")))) == rows(df.groupBy("h").agg(F.countDistinct("k")))
    assert rows(by_h.agg(distinct_count(merged(F.col("s"), 12)))) == [(n,)]


def test_error_bound_on_ten_million_keys(spark):
    n, log = 10_000_000, 14
    df = spark.range(2 * n, numPartitions=8).select((F.col("id") % n).alias("k"), (F.col("id") % 16).alias("g"))
    whole = df.groupBy("g").agg(distinct_sketch(F.col("k"), log).alias("s")).agg(distinct_count(merged(F.col("s"), log)).alias("n"))
    (found,) = whole.first()
    assert abs(found / n - 1) < 4 / 2 ** (log / 2)


def test_nothing_and_nulls(spark):
    df = spark.createDataFrame([("a", None), ("b", "x"), ("b", None), ("b", "x")], "g string, k string")
    groups = df.groupBy("g").agg(distinct_sketch(F.col("k")).alias("s"))
    assert rows(groups.select("g", distinct_count(F.col("s")))) == [("a", 0), ("b", 1)]
    assert rows(groups.where("g = 'z'").agg(distinct_count(merged(F.col("s"))))) == [(0,)]


def test_levels_come_from_the_stored_cube_alone(spark):
    cube = stored(Entities(spark, SMALL))
    found = reach(cube, ["customer_state", "customer_city"], ["order_month"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "reach-cube" in plan
    tops = found.where("level = 3").select("order_month", "customers").collect()
    cities = dict(found.where("level = 0").groupBy("order_month").agg(F.sum("customers")).collect())
    assert len(tops) > 20 and all(r.customers <= cities[r.order_month] for r in tops)
