"""Cleaned one-to-one views of the raw tables.

The ``stg_*`` functions cast safely (a bad value becomes NULL); the ``strict_*`` functions
belong to the star model and raise on a bad value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.lookups import EN, PT, translate
from tradewind.functions.scalars import clean_trim, safe_cast
from tradewind.operators.joins import repeated, salted_left_join

ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
PRODUCT_SIZES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")


def _safe(df: DataFrame, name: str, to: str, alias: str | None = None):
    is_float = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return safe_cast(F.col(name), to, from_float=is_float).alias(alias or name)


def stg_orders(raw: DataFrame) -> DataFrame:
    """Every order, all statuses; unreadable times are NULL."""
    return raw.select(
        "order_id",
        "customer_id",
        clean_trim(F.col("order_status")).alias("order_status"),
        *[_safe(raw, c, "timestamp") for c in ORDER_TIMES],
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        _safe(raw, "shipping_limit_date", "timestamp"),
        _safe(raw, "price", "double"),
        _safe(raw, "freight_value", "double"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        clean_trim(F.col("customer_city")).alias("customer_city"),
        clean_trim(F.upper("customer_state")).alias("customer_state"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    """Typed products; the misspelt ``*_lenght`` columns get their proper names."""
    return raw.select(
        "product_id",
        clean_trim(F.col("product_category_name")).alias("product_category_name"),
        _safe(raw, "product_name_lenght", "bigint", "product_name_length"),
        _safe(raw, "product_description_lenght", "bigint", "product_description_length"),
        _safe(raw, "product_photos_qty", "bigint"),
        *[_safe(raw, c, "double") for c in PRODUCT_SIZES],
    )


def stg_indicators(raw: DataFrame) -> DataFrame:
    """Observations with both a date and a value."""
    return raw.where(F.col("valor").isNotNull() & F.col("data").isNotNull()).select(
        F.col("data").alias("indicator_date"),
        F.col("valor").alias("indicator_value"),
        "series_name",
        "series_id",
        "extracted_at",
    )


def strict_customers(raw: DataFrame, geo: DataFrame, all_places: bool = False, copies: str | None = None) -> DataFrame:
    """Customers with the place of their zip prefix: the one most geolocation rows name, of equal
    ones the first by name.

    With ``all_places`` they come with every raw geolocation row of the prefix, as the planned
    star model has it. Those are not unique per prefix, so customers repeat: as many rows as
    customers times places. Equal rows are counted and copied last; with ``copies`` each different
    row comes once, with their number in a column of that name.
    """
    prefix, place = "customer_zip_code_prefix", ("geolocation_city", "geolocation_state")
    places = geo.select(F.col("geolocation_zip_code_prefix").alias(prefix), *place)
    places = places.groupBy(prefix, *place).agg(F.count("*").alias("__n"))
    if not all_places:
        first = F.min(F.struct(F.negative("__n").alias("__n"), *place)).alias("first")
        places = places.groupBy(prefix).agg(first).select(prefix, *[f"first.{c}" for c in place], F.lit(1).alias("__n"))
    found = salted_left_join(raw, places, "customer_zip_code_prefix").select(
        "customer_id",
        "customer_unique_id",
        F.lower("customer_city").alias("customer_city"),
        "customer_state",
        F.col("customer_zip_code_prefix").cast("bigint").alias("customer_zip_code_prefix"),
        "geolocation_city",
        "geolocation_state",
        F.coalesce("__n", F.lit(1)).cast("bigint").alias(copies or "__n"),
    )
    if copies:
        return found
    return repeated(found, "__n", spread=True) if all_places else found.drop("__n")


def strict_orders(raw: DataFrame, bad_ids: Sequence = ()) -> DataFrame:
    """Orders without the known-bad ids; missing approval and delivery times filled in."""
    kept = raw.where(~F.col("order_id").isin(list(bad_ids))) if bad_ids else raw
    time = {c: F.col(c).cast("timestamp") for c in ORDER_TIMES}
    return kept.select(
        "order_id",
        "customer_id",
        "order_status",
        time["order_purchase_timestamp"].alias("order_purchase_timestamp"),
        F.coalesce(time["order_approved_at"], time["order_purchase_timestamp"]).alias("order_approved_at"),
        F.coalesce(time["order_delivered_customer_date"], time["order_estimated_delivery_date"]).alias(
            "order_delivered_customer_date"
        ),
        time["order_delivered_carrier_date"].alias("order_delivered_carrier_date"),
        time["order_estimated_delivery_date"].alias("order_estimated_delivery_date"),
    )


def strict_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "payment_sequential",
        "payment_type",
        F.col("payment_installments").cast("bigint").alias("payment_installments"),
        F.col("payment_value").cast("decimal(38,9)").alias("payment_value"),
    )


def strict_items(raw: DataFrame) -> DataFrame:
    """Items as exact numbers; the total is taken on the raw columns."""
    return raw.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        F.col("price").cast("decimal(38,9)").alias("price"),
        F.col("freight_value").cast("decimal(38,9)").alias("freight_value"),
        (F.col("price") + F.col("freight_value")).alias("total_item_value"),
    )


def strict_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "review_id",
        "order_id",
        F.col("review_score").cast("bigint").alias("review_score"),
        F.col("review_creation_date").cast("timestamp").alias("review_creation_date"),
        F.col("review_answer_timestamp").cast("timestamp").alias("review_answer_timestamp"),
    )


def strict_products(raw: DataFrame, lookup: DataFrame) -> DataFrame:
    """Products with the English category, 'unmapped' where the dictionary has none."""
    return translate(raw, lookup, PT, EN).select(
        "product_id",
        PT,
        EN,
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        *[F.col(c).cast("double").alias(c) for c in PRODUCT_SIZES],
    )


def strict_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        F.col("seller_zip_code_prefix").cast("bigint").alias("seller_zip_code_prefix"),
        F.lower("seller_city").alias("seller_city"),
        "seller_state",
    )


def zip_centroids(geo: DataFrame) -> DataFrame:
    """Mean position of the distinct geolocation rows of each zip prefix."""
    return (
        geo.distinct()
        .groupBy("geolocation_zip_code_prefix")
        .agg(
            F.avg("geolocation_lat").alias("geolocation_lat"),
            F.avg("geolocation_lng").alias("geolocation_lng"),
        )
    )
