"""The star model: wide order and review facts with three dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.lookups import EN, PT
from tradewind.operators.joins import HOT_ROWS, salted_left_join
from tradewind.operators.staging import PRODUCT_SIZES


def fact_orders(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    min_hot_rows: int = HOT_ROWS,
    copies: str | None = None,
) -> DataFrame:
    """Every order with its items, payments and reviews, each combination once.

    What belongs to the customer, or to the item, is attached before orders and items meet. The three
    joins on the order come last: they share one partitioning, so orders are shuffled once for all
    of them, and the rows that they multiply are shuffled no more.

    Customers that repeat can come counted, with the number in the column ``copies``. The facts then
    have that column too: how often a row stands (`operators.joins.repeated` gives them all).
    """
    names = ["customer_id", "customer_unique_id", "customer_city", "customer_state"]
    people = customers.select(*names) if copies is None else customers.groupBy(*names).agg(F.sum(copies).alias(copies))
    rows = orders.join(people, "customer_id", "left")
    lines = items.select("order_id", "product_id", "seller_id", "price", "freight_value", "total_item_value")
    lines = lines.join(products.select("product_id", EN), "product_id", "left").join(sellers, "seller_id", "left")
    for side, counted in (
        (lines, items),
        (payments.select("order_id", "payment_type", "payment_installments", "payment_value"), None),
        (reviews.select("order_id", "review_score"), None),
    ):
        rows = salted_left_join(rows, side, "order_id", min_hot_rows, count_left=False, counted=counted)
    times = [] if copies is None else [F.coalesce(copies, F.lit(1)).alias(copies)]
    return rows.select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_customer_date",
        "order_delivered_carrier_date",
        "order_estimated_delivery_date",
        "product_id",
        EN,
        "seller_id",
        "price",
        "freight_value",
        "total_item_value",
        "payment_type",
        "payment_installments",
        "payment_value",
        "review_score",
        "seller_city",
        "seller_zip_code_prefix",
        "seller_state",
        *times,
    )


def fact_reviews(orders: DataFrame, reviews: DataFrame, min_hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every order with each of its reviews, or with none."""
    side = reviews.select("order_id", "review_score", "review_creation_date")
    return salted_left_join(orders.select("order_id", "customer_id"), side, "order_id", min_hot_rows)


def dim_customers(stg: DataFrame, copies: str | None = None) -> DataFrame:
    return stg.select(
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "customer_zip_code_prefix",
        "geolocation_city",
        "geolocation_state",
        *([copies] if copies else []),
    )


def dim_products(stg: DataFrame) -> DataFrame:
    return stg.select("product_id", PT, EN, *PRODUCT_SIZES)


def dim_sellers(stg: DataFrame) -> DataFrame:
    return stg.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
