"""Plans and skew: what has to hold when the data is large."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import SMALL, final_plan, rows
from suite.entities import Entities
from tradewind.operators import medians, quality, staging
from tradewind.operators.joins import hot_values, left_join_many, salted_left_join
from tradewind.plans import marts, reports, star
from tradewind.session import keep
from tradewind.sources.tables import materialize

QUERIES = contract.queries()


@pytest.mark.parametrize(
    "name",
    ["d1_orders_econ", "d2_customer_items", "d3_category", "d4_geo", "d5_category_wide", "d6_geo_wide",
     "d7_fact_orders", "d8_fact_reviews", "d10_analysis_frame", "a22_median_payment", "i2_median_fill",
     "i7_geo_fill", "q8_run_checks", "x22_elasticity", "w2_fx_ffill", "f6_default_selection"],
)
def test_no_cross_joins_and_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert bad not in plan


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["d3_category"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,l_tax:double>" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_partkey)]" in plan


def test_facts_are_not_broadcast(spark, conf):
    """Beyond the limit, a table is shuffled: no hint overrules Spark's size check."""
    conf(spark__sql__autoBroadcastJoinThreshold="4KB", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    e = Entities(spark, SMALL)
    mart = marts.fct_category(e.items, e.orders, e.products, e.customers, e.lookup, e.ind)
    assert mart._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") >= 3


@pytest.fixture
def low_skew_limits(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


def hot(spark, n=60_000):
    """A third of the items on one order and one product."""
    return spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 900).alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 70).alias("product_id"),
        (F.col("id") % 100).cast("double").alias("price"),
        F.lit(1.0).alias("freight_value"),
        F.col("id").alias("tag"),
    )


def test_hot_keys_are_split_in_marts(spark, low_skew_limits):
    e = Entities(spark, SMALL)
    items = hot(spark)
    orders = e.orders.where("order_id < 900")
    mart = marts.fct_customer_items(e.customers, orders, items, e.products, e.ind)
    assert "skew=true" in final_plan(mart)
    sold = orders.where(F.col("order_status").isin(*marts.SOLD))
    # Every customer is known, and rates are unique per day and month.
    assert mart.count() == items.join(sold, "order_id").count()


@pytest.mark.parametrize("min_rows", [1_000, 10**9])
def test_left_join_with_a_hot_right_side(spark, low_skew_limits, min_rows):
    left = spark.range(1000, numPartitions=4).select(
        F.nullif("id", F.lit(13)).alias("order_id"), (F.col("id") * 2).alias("x")
    )
    right = hot(spark).select("order_id", "tag")
    joined = left_join_many(left, right, "order_id", min_rows)
    plain = left.join(right, "order_id", "left")
    assert joined.count() == plain.count()
    assert joined.exceptAll(plain).count() == 0
    if min_rows == 1_000:
        assert hot_values(right, "order_id", min_rows) == [7]
        assert "skew=true" in final_plan(joined)


def test_hot_keys_found_are_only_a_route(spark):
    e = Entities(spark, SMALL)
    items = hot(spark, 3_000).withColumns({"seller_id": F.lit(1), "total_item_value": F.lit(2.0)})
    args = (
        e.orders.where("order_id < 900"), items, e.raw_payments, e.raw_reviews, e.customers,
        e.products.withColumn("product_category_name_english", F.lit("x")), e.raw_sellers,
    )
    assert rows(star.fact_orders(*args, min_hot_rows=500).groupBy("order_id").count()) == rows(
        star.fact_orders(*args).groupBy("order_id").count()
    )


def test_hot_keys_in_checks(spark, low_skew_limits):
    items = hot(spark)
    parents = spark.range(1, 900).select(F.col("id").alias("order_id"))
    checks = [
        quality.Check("items", "order_id", "relationships", "warn", ("orders", "order_id")),
        quality.Check("items", "order_id", "unique"),
    ]
    results = quality.run_checks({"items": items, "orders": parents}, checks)
    got = {r.check_name.split(": ")[1]: r.failures for r in results.collect()}
    keys = items.groupBy("order_id").count()
    assert got == {
        "relationships": items.where("order_id = 0").count(), "unique": keys.where("count > 1").count(),
    }


def test_median_orders_little_of_a_hot_group(spark):
    """The window ranks an aggregate of the bracket, not the rows of the group."""
    n = 200_000
    df = spark.range(n, numPartitions=8).select(F.lit("k").alias("k"), (F.col("id") * 104_729 % n).alias("v"))
    result = medians.medians(df, ["k"], ["v"])
    assert rows(result) == [("k", (n - 1) / 2)]
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window ["):]
    assert "Aggregate [" in window[: window.index("Join Inner")]


def test_bucketed_tables_need_no_shuffle_on_the_order(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    e = Entities(spark, SMALL)
    orders = materialize(e.raw_orders, "bucketed_orders", "table", bucket_by=(4, "order_id"))
    items = materialize(e.raw_items, "bucketed_items", "table", bucket_by=(4, "order_id"))
    staged = staging.stg_orders(orders), staging.stg_order_items(items)
    totals = marts.fct_orders(*staged, e.ind)
    text = totals._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(order_id" not in text
    assert rows(totals.select("order_id", "order_value_brl")) == rows(
        marts.fct_orders(e.orders, e.items, e.ind).select("order_id", "order_value_brl")
    )
    spark.sql("DROP TABLE bucketed_orders")
    spark.sql("DROP TABLE bucketed_items")


def test_report_filters_reach_the_stored_mart(spark, conf):
    conf(spark__sql__maxMetadataStringLength="1000")
    mart = keep(QUERIES["d3_category"](spark, SMALL), "mart")
    chosen = reports.apply_filters(reports.load_category(mart), months=("1996-01-01", "1996-12-01"), states=["NATION_1"])
    plan = reports.monthly(chosen)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(order_month,1996-01-01)" in pushed and "EqualTo(customer_state,NATION_1)" in pushed
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "total_revenue_brl" not in read


def test_left_join_with_nothing_on_the_right(spark):
    left = spark.range(3).withColumnRenamed("id", "k")
    right = left.where("k > 5").withColumn("v", F.lit(1))
    assert rows(left_join_many(left, right, "k", 1)) == [(0, None), (1, None), (2, None)]
    nulls = spark.range(2).select(F.lit(None).cast("bigint").alias("k"), F.lit(1).alias("v"))
    assert rows(left_join_many(left, nulls, "k", 1)) == [(0, None), (1, None), (2, None)]


def test_a_large_ordered_limit_is_a_distributed_sort(spark):
    df = spark.read.parquet(f"{SMALL}/orders.parquet").select(F.col("o_custkey").alias("id"))
    small = reports.load_customer(df, 100, ["id"])._jdf.queryExecution().executedPlan().toString()
    large = reports.load_customer(df, 100_000, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in small and "TakeOrderedAndProject" not in large


def test_the_sensitivity_report_reads_the_mart_once(spark):
    plan = final_plan(QUERIES["x22_elasticity"](spark, SMALL))
    assert "ReusedExchange" in plan


def test_row_checks_of_a_table_share_one_scan(spark):
    df = spark.read.parquet(f"{SMALL}/orders.parquet")
    checks = [quality.Check("o", c, "not_null") for c in df.columns]
    plan = quality.run_checks({"o": df}, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_listing_files_reads_no_contents(spark):
    plan = quality.recency(spark, {"a": f"{SMALL}/orders.parquet"}, F.current_timestamp())
    assert "content" not in plan._jdf.queryExecution().executedPlan().toString()


def keyed(spark, sizes, columns):
    """Rows of the keys 0, 1, ...: as many of each as ``sizes`` says."""
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    key = F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e <= F.col("id")))
    return keep(spark.range(ends[-1], numPartitions=4).select(key.alias("k"), F.col("id").alias(columns)), columns)


@pytest.mark.parametrize("min_rows", [1, 20, 700, 10**9])
def test_salted_joins_equal_plain_ones(spark, min_rows):
    """Keys hot on either side, on both, and on neither; keys that one side lacks; null keys; equal rows."""
    left = keyed(spark, [900, 3, 40, 2, 0, 500, 7], "x").withColumn("k", F.nullif("k", F.lit(6)))
    right = keyed(spark, [2, 800, 30, 0, 600, 0, 5], "y").withColumn("k", F.nullif("k", F.lit(6)))
    left = left.withColumn("x", F.when(F.col("k") == 2, 1).otherwise(F.col("x")))
    plain = left.join(right, "k", "left")
    for count_left in (True, False):
        joined = salted_left_join(left, right, "k", min_rows, count_left)
        assert joined.columns == plain.columns and rows(joined) == rows(plain)


def test_a_hundred_and_fifty_hot_keys_are_spread(spark, conf):
    """No key and no task gets much more than the others, without Spark's own splitting."""
    conf(
        spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="64",
    )
    left = keyed(spark, [60] * 150, "x")
    right = keyed(spark, [400] * 150 + [1] * 50, "y")
    joined = salted_left_join(left, right, "k", 50)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 150 * 60 * 400
    assert len(sizes) >= 64 and max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]


def test_one_place_for_each_prefix(spark):
    geo = spark.createDataFrame(
        [("1", "b", "S"), ("1", "a", "S"), ("1", "b", "S"), ("2", "y", "S"), ("2", "x", "S")],
        "geolocation_zip_code_prefix string, geolocation_city string, geolocation_state string",
    )
    raw = spark.createDataFrame(
        [(i, f"u{i}", "CITY", "S", p) for i, p in enumerate(["1", "2", "3"])],
        "customer_id int, customer_unique_id string, customer_city string, customer_state string, customer_zip_code_prefix string",
    )
    found = staging.strict_customers(raw, geo).select("customer_id", "geolocation_city")
    assert rows(found) == [(0, "b"), (1, "x"), (2, None)]
    assert staging.strict_customers(raw, geo, all_places=True).count() == 6
