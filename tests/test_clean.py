"""Medians, fills, profiles."""

import datetime as dt
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tradewind.operators import clean, medians, profile


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.floats(-1e6, 1e6).map(lambda v: round(v, 2)))),
        min_size=1, max_size=60,
    )
)
def test_median_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, v double")
    groups = {}
    for k, v in data:
        groups.setdefault(k, []).extend([] if v is None else [v])
    expected = {k: statistics.median(v) if v else None for k, v in groups.items()}
    assert {r.k: r.v for r in medians.medians(df, ["k"], ["v"]).collect()} == expected


@pytest.mark.parametrize("accuracy", [20, 10_000])
@pytest.mark.parametrize("n", [1, 2, 999, 1000, 30_001])
def test_median_with_a_coarse_sketch(spark, n, accuracy):
    """The bracket holds whatever the sketch misses by, and groups of one value are no problem."""
    df = spark.range(n).select(
        F.lit("spread").alias("k"), (F.col("id") * 7919 % n).cast("double").alias("v")
    ).unionByName(spark.range(n).select(F.lit("flat").alias("k"), F.lit(5.0).alias("v")))
    got = {r.k: r.v for r in medians.medians(df, ["k"], ["v"], accuracy=accuracy).collect()}
    assert got == {"spread": statistics.median(range(n)), "flat": 5.0}


@pytest.mark.parametrize("n", [4_000, 4_001])
def test_median_of_a_group_too_large_to_order(spark, n):
    """With room for 50 rows the tally is narrowed step by step, repeated values included."""
    spread = spark.range(n).select(F.lit("spread").alias("k"), (F.col("id") * 7919 % n).cast("double").alias("v"))
    steps = spark.range(n).select(F.lit("steps").alias("k"), F.floor(F.sqrt("id")).cast("double").alias("v"))
    tail = spark.range(n).select(F.lit("tail").alias("k"), F.exp(F.col("id") / 100).alias("v"))
    df = spread.unionByName(steps).unionByName(tail)
    expected = df.groupBy("k").agg(F.median("v").alias("v"))
    got = medians.medians_long(df, ["k"], ["v"], accuracy=20, window_rows=50).select("k", "median")
    assert rows(got) == rows(expected)


def test_approximate_median(spark):
    df = spark.range(101).selectExpr("'a' k", "cast(id AS double) v")
    assert rows(medians.medians(df, ["k"], ["v"], exact=False)) == [("a", 50.0)]


def test_group_median_fill(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (2, "a", 3.0), (3, "a", None), (4, "b", None), (5, None, None), (6, None, 9.0)],
        "id int, city string, lat double",
    )
    got = rows(medians.fill_with_group_median(df, "city", ["lat"]).select("id", "lat"), "id")
    assert got == [(1, 1.0), (2, 3.0), (3, 2.0), (4, None), (5, None), (6, 9.0)]


def test_geo_fill_takes_the_global_median_after_the_city_fill(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (2, "a", None), (3, "a", None), (4, "c", 8.0), (5, "b", None), (6, None, None)],
        "id int, customer_city string, geolocation_lat double",
    ).withColumn("geolocation_lng", F.lit(0.0))
    got = rows(clean.fill_geo(df).select("id", "geolocation_lat"), "id")
    # After the city fill: 1, 1, 1, 8 - median 1. Before it would have been 4.5.
    assert got == [(1, 1.0), (2, 1.0), (3, 1.0), (4, 8.0), (5, 1.0), (6, 1.0)]


def test_fill_products(spark):
    df = spark.createDataFrame(
        [("p1", "toys", 1.0, 1), ("p2", None, None, 2), ("p3", "pcs", 4.0, 3)],
        "product_id string, product_category_name string, product_weight_g double, product_photos_qty int",
    )
    got = rows(clean.fill_products(df, ["product_weight_g"]), "product_id")
    assert got == [("p1", "toys", 1.0), ("p2", "unknown", 2.5), ("p3", "pcs", 4.0)]


def test_fill_orders(spark):
    t = dt.datetime(2018, 1, 1)
    u = dt.datetime(2018, 2, 2)
    df = spark.createDataFrame(
        [("a", "delivered", t, None, None, u), ("b", "canceled", t, u, u, u), ("bad", "delivered", t, t, t, t),
         (None, "shipped", t, None, None, u)],
        "order_id string, order_status string, order_purchase_timestamp timestamp, order_approved_at timestamp, "
        "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
    )
    got = rows(
        clean.fill_orders(df, ["bad"]).select("order_id", "order_approved_at", "order_delivered_customer_date")
    )
    assert got == [("a", t, u), ("b", u, u), (None, t, u)]
    only = clean.approve_delivered(df).select("order_id", "order_approved_at")
    assert dict(rows(only))["a"] == t and dict(rows(only))[None] is None


def test_payment_type_and_semi_join(spark):
    pay = spark.createDataFrame([("a", None), ("b", "boleto"), ("b", "voucher")], "order_id string, payment_type string")
    assert rows(clean.fill_payment_type(pay))[0] == ("a", "not_defined")
    ids = spark.createDataFrame([("b",), ("b",), (None,)], "order_id string")
    assert rows(clean.only_in(pay, ids, "order_id")) == [("b", "boleto"), ("b", "voucher")]


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "y")], "a int, b string")
    assert rows(profile.duplicate_rows(df)) == [(False, 3), (True, 1)]
    assert rows(profile.duplicate_rows(df, ["a"])) == [(False, 2), (True, 2)]
    assert clean.dedupe(df).count() == 3 and clean.dedupe(df, ["a"]).count() == 2
    assert rows(profile.null_counts(df)) == [("a", 0), ("b", 2)]
    assert profile.completeness(df).first()[0] == 0.75
    assert rows(profile.profile(df)) == [("a", "int", 4, 2), ("b", "string", 4, 2)]


def test_empty_table_profiles(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert rows(profile.duplicate_rows(empty)) == [(False, 0), (True, 0)]
    assert rows(profile.null_counts(empty)) == [("a", 0), ("b", 0)]
    assert profile.completeness(empty).first()[0] is None


def test_counts_and_ranks_break_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "k string")
    counts = profile.value_counts(df, "k")
    assert [tuple(r) for r in counts.collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert rows(profile.top_bottom(counts, "row_count", 1)) == [("a", 2)]
    assert rows(profile.top_bottom(counts, "row_count", 2, largest=False)) == [("a", 2), ("c", 1)]


def test_rounding_to_even(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 3.0), ("b", None, None)], "g string, s int, p double")
    assert rows(profile.mean_rating(df, "g", "s")) == [("a", 1.5), ("b", None)]
    assert rows(profile.median_payment(df, "g", "p")) == [("a", 2), ("b", None)]


def test_row_counts_with_total(spark):
    got = rows(profile.row_counts({"a": spark.range(2), "b": spark.range(3)}))
    assert got == [("a", 2), ("b", 3), ("total", 5)]


def test_sample_and_peek(spark):
    assert profile.sample_rows(spark.range(100), 3, 1).count() == 3
    assert rows(profile.peek(spark.range(100), 2, "id")) == [(0,), (1,)]
    assert profile.peek(spark.range(100), 2).count() == 2


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(-9, 9)), st.integers(1, 4)), min_size=1, max_size=40),
    st.sampled_from([3, 1000]),
)
def test_weighted_median_equals_repeated_rows(spark, data, window_rows):
    df = spark.createDataFrame([(k, None if v is None else float(v), n) for k, v, n in data], "k string, v double, n long")
    groups = {}
    for k, v, n in data:
        if v is not None:
            groups.setdefault(k, []).extend([float(v)] * n)
    got = medians.weighted_medians(df, ["k"], ["v"], "n", window_rows).collect()
    assert {r.k: r.v for r in got} == {k: statistics.median(v) for k, v in groups.items()}
