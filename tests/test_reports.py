"""Report tables on a small mart, and the planned comparisons."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradewind.functions.lookups import display_category
from tradewind.plans import outlook, reports

JAN, FEB = dt.date(2018, 1, 1), dt.date(2018, 2, 1)


@pytest.fixture(scope="module")
def cat(spark):
    data = [
        ("toys", "brinquedos", JAN, "SP", 4, 40.0, 10.0, 10.0, 3.0, "Strong BRL"),
        ("toys", "brinquedos", FEB, "SP", 6, 60.0, 12.0, 10.0, 5.0, "Weak BRL"),
        ("pcs", "pcs", JAN, "RJ", 1, 9.0, None, 9.0, None, "Weak BRL"),
        ("art", "artes", FEB, None, 2, 5.0, 22.0, 2.5, 4.0, "Moderate BRL"),
    ]
    df = spark.createDataFrame(
        data,
        "category_name string, category_name_pt string, order_month date, customer_state string, "
        "order_count long, total_revenue_brl double, total_revenue_usd double, avg_order_value_brl double, "
        "avg_exchange_rate double, exchange_rate_period string",
    )
    return display_category(df)


def test_kpis(cat):
    assert tuple(reports.kpis(cat).first()) == (13, 44.0, 4.0, 3)
    assert tuple(reports.kpis(cat.where("false")).first()) == (0, 0.0, None, 0)


def test_monthly_mean_is_unweighted_and_skips_gaps(cat):
    assert rows(reports.monthly(cat), "order_month") == [(JAN, 10.0, 5, 3.0), (FEB, 34.0, 8, 4.5)]


def test_an_empty_sum_is_zero(cat):
    got = rows(reports.category_by_period(cat.where("category_name = 'pcs'")))
    assert got == [("pcs", "Weak BRL", 1, 0.0)]


def test_ties_are_ordered_by_name(cat):
    top = reports.top_categories(cat, 2)
    assert [tuple(r)[:3] for r in top.collect()] == [("art", 2, 22.0), ("toys", 10, 22.0)]


def test_trend_and_summary(cat):
    assert rows(reports.category_trend(cat, "toys")) == [(JAN, 4, 10.0), (FEB, 6, 12.0)]
    summary = {r[0]: tuple(r)[1:] for r in reports.period_summary(cat).collect()}
    assert summary["Weak BRL"] == (7, 12.0, 5.0)


def test_missing_states_are_left_out(cat):
    assert rows(reports.state_sales(cat)) == [("RJ", 1, 0.0), ("SP", 10, 22.0)]
    assert rows(reports.state_sales(cat, 1)) == [("SP", 10, 22.0)]


def test_pivot_fills_with_zero_and_adds_up(cat):
    grid = reports.pivot_counts(
        reports.state_category(cat), "customer_state", "display_category", "order_count", ["toys", "pcs", "none"]
    )
    assert rows(grid) == [("RJ", 0, 1, 0), ("SP", 10, 0, 0)]


def test_filters(cat):
    assert reports.apply_filters(cat, months=("2018-01-02", "2018-02-01")).count() == 2
    assert reports.apply_filters(cat, months=("2018-01-01", "2018-01-01")).count() == 2
    both = reports.apply_filters(cat, categories=["toys", "pcs"], periods=["Weak BRL"])
    assert rows(both.select("category_name")) == [("pcs",), ("toys",)]
    assert reports.apply_filters(cat, states=["SP"]).count() == 2
    first = reports.default_selection(cat, "category_name", 2)
    assert rows(first) == [("art",), ("pcs",)]
    assert rows(reports.apply_filters(cat, categories=first).select("category_name")) == [("art",), ("pcs",)]
    assert rows(reports.default_selection(cat, "customer_state")) == [("RJ",), ("SP",)]


def test_top_cities(spark):
    geo = spark.createDataFrame(
        [("SP", "santos", 1, 5.0), ("SP", "santos", 1, 5.0), ("RJ", "niteroi", 3, 10.0), ("RJ", None, 9, 99.0)],
        "customer_state string, customer_city string, order_count long, total_revenue_usd double",
    )
    got = [tuple(r) for r in reports.top_cities(geo, 5).collect()]
    assert got == [("RJ", "niteroi", 3, 10.0, "niteroi, RJ"), ("SP", "santos", 2, 10.0, "santos, SP")]


def test_elasticity(cat):
    got = [tuple(r) for r in reports.elasticity(cat).collect()]
    # art sells in the moderate period only, pcs not in the strong one.
    assert got == [("toys", 50.0), ("art", 0.0), ("pcs", 0.0)]
    for period in ("Strong BRL", "Weak BRL"):
        assert reports.elasticity(cat.where(F.col("exchange_rate_period") != period)).count() == 0


def test_loads(cat, spark):
    got = reports.load_category(cat.withColumn("category_name", F.nullif("category_name", F.lit("pcs"))))
    assert [r.category_name for r in got.collect()] == ["art", "toys", "toys"]
    assert reports.load_customer(cat).count() == cat.count()
    assert reports.load_customer(cat, 2, ["category_name"]).count() == 2
    with pytest.raises(ValueError, match="order"):
        reports.load_customer(cat, 2)
    assert rows(reports.load_customer(cat, 1, ["category_name"]).select("category_name")) == [("art",)]
    wide = cat.withColumnRenamed("category_name_pt", "product_category_name")
    assert reports.load_wide(wide).first().order_month == FEB


def test_newest_per_key(spark):
    old = spark.createDataFrame([("a", "x", 1), ("b", "y", 5)], "k string, v string, t int")
    new = spark.createDataFrame([("a", "z", 2), ("c", "w", 1), ("b", "late", 4)], "k string, v string, t int")
    assert rows(outlook.newest_per_key(old, new, ["k"], "t")) == [("a", "z", 2), ("b", "y", 5), ("c", "w", 1)]
    # A correction with the same time replaces the stored row.
    fixed = spark.createDataFrame([("b", "a", 5)], "k string, v string, t int")
    assert rows(outlook.newest_per_key(old, fixed, ["k"], "t")) == [("a", "x", 1), ("b", "a", 5)]


def test_year_over_year(spark):
    df = spark.createDataFrame(
        [(dt.date(2017, 3, 1), 2, 5.0), (dt.date(2018, 3, 1), 3, 7.0)],
        "order_month date, order_count long, total_revenue_usd double",
    )
    assert rows(outlook.year_over_year(df), "order_month") == [
        (dt.date(2017, 3, 1), 2, 5.0, None, None), (dt.date(2018, 3, 1), 3, 7.0, 2, 5.0),
    ]


def test_dates_without_gaps(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 2, 27, 5),), (dt.datetime(2018, 3, 4),)], "t timestamp")
    days = outlook.dim_date(df, "t").orderBy("date_day").collect()
    assert [d.date_day.day for d in days] == [27, 28, 1, 2, 3, 4]
    assert [d.is_weekend for d in days] == [False] * 4 + [True] * 2
