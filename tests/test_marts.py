"""Marts and indicator joins on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from suite.entities import Entities
from tradewind.functions.lookups import category_lookup, display_category, lookup_frame, reverse, translate
from tradewind.operators import indicators
from tradewind.plans import build, marts, star
from tradewind.session import scratch_path


def day(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def shop(spark):
    """Four orders over a weekend, with gaps of every kind."""
    orders = spark.createDataFrame(
        [
            ("o1", "c1", "delivered", day("2017-05-19T10:00")),  # Friday
            ("o2", "c1", "shipped", day("2017-05-20T10:00")),  # Saturday
            ("o3", "c2", "canceled", day("2017-05-22T10:00")),  # Monday
            ("o4", "c2", "approved", day("2017-05-18T23:59")),  # before the first rate
        ],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp",
    )
    items = spark.createDataFrame(
        [
            ("o1", "p1", "s1", 100.0, 10.0),
            ("o1", "p2", "s1", 50.0, 0.0),
            ("o2", "p9", "s1", 20.0, 5.0),  # unknown product
            ("o3", "p1", "s2", 70.0, 7.0),
            ("o2", "p3", "s1", 30.0, None),  # product without category, freight missing
        ],
        "order_id string, product_id string, seller_id string, price double, freight_value double",
    )
    customers = spark.createDataFrame(
        [("c1", "u1", "01", "recife", "PE"), ("c2", "u2", "02", "natal", "RN")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string",
    )
    products = spark.createDataFrame(
        [("p1", "brinquedos", 300.0), ("p2", "raridades", None), ("p3", None, 5.0)],
        "product_id string, product_category_name string, product_weight_g double",
    )
    ind = spark.createDataFrame(
        [
            (dt.date(2017, 5, 19), 3.3, "exchange_rate_usd"),
            (dt.date(2017, 5, 22), 0.0, "exchange_rate_usd"),
            (dt.date(2017, 5, 1), 0.31, "ipca"),
            (dt.date(2017, 5, 1), 11.25, "selic"),
        ],
        "indicator_date date, indicator_value double, series_name string",
    )
    lookup = lookup_frame(spark, [("brinquedos", "toys")])
    return dict(orders=orders, items=items, customers=customers, products=products, ind=ind, lookup=lookup)


def test_orders_keep_every_order(shop):
    got = rows(
        marts.fct_orders(shop["orders"], shop["items"], shop["ind"]).select(
            "order_id", "order_value_brl", "freight_value_brl", "total_order_value_brl", "usd_brl_rate",
            "total_order_value_usd", "ipca_month", "selic_month",
        ),
        "order_id",
    )
    assert got == [
        ("o1", 150.0, 10.0, 160.0, 3.3, 48.48, 0.31, 11.25),
        ("o2", 50.0, 5.0, 55.0, None, None, 0.31, 11.25),  # the missing freight is left out of its sum
        ("o3", 70.0, 7.0, 77.0, 0.0, None, 0.31, 11.25),  # a zero rate converts nothing
        ("o4", None, None, None, None, None, 0.31, 11.25),
    ]


def test_weekend_rate_carries_friday_on(shop):
    got = rows(
        marts.fct_orders(shop["orders"], shop["items"], shop["ind"], "ffill").select("order_id", "usd_brl_rate"),
        "order_id",
    )
    assert got == [("o1", 3.3), ("o2", 3.3), ("o3", 0.0), ("o4", None)]


def test_fill_changes_only_missing_rates(shop):
    exact = marts.fct_orders(shop["orders"], shop["items"], shop["ind"]).where("usd_brl_rate IS NOT NULL")
    filled = marts.fct_orders(shop["orders"], shop["items"], shop["ind"], "ffill")
    assert exact.exceptAll(filled).count() == 0


def test_fill_within_bounds(spark, shop):
    got = rows(indicators.ffill_daily(shop["ind"], "exchange_rate_usd", "2017-05-21", "2017-05-23"))
    assert got == [
        (dt.date(2017, 5, 21), 3.3), (dt.date(2017, 5, 22), 0.0), (dt.date(2017, 5, 23), 0.0),
    ]


def test_unknown_policies(shop):
    with pytest.raises(ValueError):
        indicators.with_fx(shop["orders"], "d", shop["ind"], "nearest")
    with pytest.raises(ValueError):
        indicators.with_monthly(shop["orders"], "order_purchase_timestamp", shop["ind"], {"ipca": "i"}, "last")


def test_two_values_in_a_month_repeat_the_order(spark, shop):
    more = shop["ind"].unionByName(
        spark.createDataFrame([(dt.date(2017, 5, 31), 10.25, "selic")], shop["ind"].schema)
    )
    mart = marts.fct_orders(shop["orders"], shop["items"], more)
    assert mart.count() == 8
    for dedupe, value in (("first", 11.25), ("avg", 10.75)):
        once = marts.fct_orders(shop["orders"], shop["items"], more, monthly=dedupe)
        assert rows(once.select("selic_month")) == [(value,)] * 4


def test_customer_items(shop):
    got = rows(
        marts.fct_customer_items(
            shop["customers"], shop["orders"], shop["items"], shop["products"], shop["ind"]
        ).select(
            "order_id", "product_id", "product_category_name", "total_item_value", "total_item_value_usd",
            "exchange_rate_category", "interest_rate_category",
        ),
        "order_id", "product_id",
    )
    moderate = "Moderate Interest (7-12%)"
    assert got == [
        ("o1", "p1", "brinquedos", 110.0, 33.33, "Strong BRL (< 3.5)", moderate),
        ("o1", "p2", "raridades", 50.0, 15.15, "Strong BRL (< 3.5)", moderate),
        ("o2", "p3", None, None, None, "Weak BRL (> 4.5)", moderate),  # no rate falls through
        ("o2", "p9", None, 25.0, None, "Weak BRL (> 4.5)", moderate),
    ]


def test_category_falls_back_to_the_original_name(shop):
    got = rows(
        marts.fct_category(
            shop["items"], shop["orders"], shop["products"], shop["customers"], shop["lookup"], shop["ind"]
        ),
        "category_name",
    )
    month = dt.date(2017, 5, 1)
    assert got == [
        ("raridades", "raridades", month, "PE", 1, 50.0, 50.0, 3.3, 15.15, "Strong BRL"),
        ("toys", "brinquedos", month, "PE", 1, 110.0, 110.0, 3.3, 33.33, "Strong BRL"),
    ]


def test_geo_keeps_the_unknown_category(shop):
    mart = marts.fct_geo(
        shop["items"], shop["orders"], shop["products"], shop["customers"], shop["lookup"], shop["ind"]
    )
    unknown = mart.where("category_name IS NULL").first()
    # Two items, one without a total; no rate at all: the sum is missing, the currency weak.
    assert (unknown.order_count, unknown.total_revenue_brl, unknown.avg_exchange_rate) == (2, 25.0, None)
    assert (unknown.total_revenue_usd, unknown.currency_strength) == (None, "Weak BRL")


def test_marts_agree_on_totals(spark):
    e = Entities(spark, SMALL)
    cube = marts.sales_cube(e.items, e.orders, e.products, e.customers, e.lookup, e.ind)
    items = marts.fct_customer_items(e.customers, e.orders, e.items, e.products, e.ind)
    assert marts.geo_from_cube(cube).agg(F.sum("order_count")).first()[0] == items.count()
    direct = marts.fct_category(e.items, e.orders, e.products, e.customers, e.lookup, e.ind)
    coarser = marts.category_from_cube(cube)
    assert direct.exceptAll(coarser).count() == coarser.exceptAll(direct).count() == 0
    wide = marts.sales_cube(
        e.items, e.orders, e.products, e.customers, None, e.ind, marts.WIDE_BY_PLACE, True
    )
    direct = marts.fct_category(e.items, e.orders, e.products, e.customers, None, e.ind, wide=True)
    assert direct.exceptAll(marts.category_wide_from_cube(wide)).count() == 0


def test_partitioning_changes_no_digit(spark, conf):
    e = Entities(spark, SMALL)
    mart = lambda: marts.fct_category(
        e.items.repartition(5), e.orders, e.products, e.customers, e.lookup, e.ind
    )
    conf(spark__sql__shuffle__partitions="3")
    first = rows(mart())
    conf(spark__sql__shuffle__partitions="17")
    assert rows(mart()) == first


def test_an_order_of_any_size(spark, shop):
    """Totals far beyond what a single item may cost."""
    many = spark.range(1000).selectExpr(
        "'o1' order_id", "'p1' product_id", "'s' seller_id", "9e9D price", "0.5D freight_value"
    )
    order = marts.fct_orders(shop["orders"], many, shop["ind"]).where("order_id = 'o1'").first()
    assert order.total_order_value_brl == 9_000_000_000_500.0
    assert order.total_order_value_usd == pytest.approx(9_000_000_000_500.0 / 3.3, abs=0.01)
    mart = marts.fct_category(
        many, shop["orders"], shop["products"], shop["customers"], shop["lookup"], shop["ind"]
    ).first()
    assert mart.total_revenue_usd == pytest.approx(9_000_000_000_500.0 / 3.3, abs=0.01)


def test_fact_orders_multiplies(spark):
    orders = spark.createDataFrame([("o", "c")], "order_id string, customer_id string").select(
        "*", F.lit("delivered").alias("order_status"),
        *[F.lit(None).cast("timestamp").alias(c) for c in (
            "order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date",
            "order_delivered_carrier_date", "order_estimated_delivery_date")],
    )
    two = spark.range(2)
    items = two.selectExpr("'o' order_id", "concat('p', id) product_id", "'s' seller_id", "1.0 price",
                           "1.0 freight_value", "2.0 total_item_value")
    payments = two.selectExpr("'o' order_id", "'boleto' payment_type", "1L payment_installments", "id payment_value")
    reviews = two.selectExpr("'o' order_id", "id review_score")
    customers = spark.sql("SELECT 'c' customer_id, 'u' customer_unique_id, 'x' customer_city, 'y' customer_state")
    products = two.selectExpr("concat('p', id) product_id", "'toys' product_category_name_english")
    sellers = spark.sql("SELECT 's' seller_id, 'x' seller_city, 1L seller_zip_code_prefix, 'y' seller_state")
    facts = star.fact_orders(orders, items, payments, reviews, customers, products, sellers)
    assert facts.count() == facts.distinct().count() == 8


def test_dictionary(spark):
    lookup = category_lookup(spark)
    assert lookup.count() == lookup.select("product_category_name_english").distinct().count() == 74
    df = spark.createDataFrame([("audio",), ("pcs",), ("new",), (None,)], "pt string")
    english = translate(df, lookup, "pt", "en")
    back = translate(english, reverse(lookup), "en", "again")
    assert rows(back.select("en", "again")) == [
        ("audio", "audio"), ("pcs", "pcs"), ("unmapped", "unmapped"), ("unmapped", "unmapped"),
    ]


def test_display_languages(spark):
    df = spark.createDataFrame([("toys", "brinquedos"), ("x", None)], "category_name string, category_name_pt string")
    for lang, shown in (
        ("English", ["toys", "x"]), ("Portuguese", ["brinquedos", None]), ("Both", ["toys (brinquedos)", None]),
    ):
        assert [r.display_category for r in display_category(df, lang).collect()] == shown


def test_full_run(spark):
    e = Entities(spark, SMALL)
    raw = {
        "orders": e.raw_orders, "order_items": e.raw_items, "customers": e.raw_customers,
        "products": e.raw_products, "payments": e.raw_payments, "indicators": e.raw_indicators,
    }
    stored, results, report = build.run_all(spark, raw, e.lookup, scratch_path(spark, "run"))
    assert set(stored) == set(build.LAYOUT) and all("updated_at" in df.columns for df in stored.values())
    assert results.count() == 47
    line = report.first()
    assert line.tables_built == 4 and line.status == "FAILED"
    assert line.total_rows == sum(df.count() for df in stored.values())
