"""The consolidated frame for exploration: orders with everything known about them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.lookups import PT, reverse, translate
from tradewind.operators.clean import fill_geo, fill_orders, fill_payment_type
from tradewind.operators.joins import salted_left_join
from tradewind.operators.staging import zip_centroids
from tradewind.session import keep


def analysis_frame(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    products: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    sellers: DataFrame,
    geo: DataFrame,
    lookup: DataFrame,
    bad_ids: Sequence = (),
) -> DataFrame:
    """One row per order, item, payment and review, cleaned and with both category names.

    The joined rows are stored before the coordinates are filled, since the fill reads
    them several times, two columns at a time.
    """
    rows = fill_orders(orders, bad_ids)
    for side in (
        items.select("order_id", "product_id", "seller_id", "price"),
        payments.select("order_id", "payment_type", "payment_value", "payment_installments"),
        reviews.select("order_id", "review_score", "review_creation_date"),
    ):
        rows = salted_left_join(rows, side, "order_id", count_left=False)
    who = customers.select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"
    )
    rows = rows.join(who, "customer_id", "left")
    rows = rows.join(
        products.select("product_id", PT).fillna({PT: "unknown"}), "product_id", "left"
    )
    rows = rows.join(sellers.select("seller_id", "seller_city"), "seller_id", "left")
    spots = zip_centroids(geo)
    rows = rows.join(
        spots, F.col("customer_zip_code_prefix") == F.col("geolocation_zip_code_prefix"), "left"
    )
    rows = fill_payment_type(rows)
    rows = translate(rows, lookup, PT, "product_category_english")
    rows = translate(rows, reverse(lookup), "product_category_english", "product_category_portuguese")
    return fill_geo(keep(rows, "analysis-frame"))
