"""Filling gaps and dropping repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.lookups import PT
from tradewind.operators.medians import fill_with_median, weighted_medians
from tradewind.operators.staging import PRODUCT_SIZES
from tradewind.session import keep


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep one of each set of equal rows (NULLs count as equal)."""
    return df.dropDuplicates(list(subset) if subset else None)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values of a column."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def null_mask(col: str, status: str | None = None) -> Column:
    """``col`` is missing, optionally on orders of one status."""
    missing = F.col(col).isNull()
    return missing if status is None else missing & (F.col("order_status") == status)


def only_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key appears in ``ids``."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def fill_products(df: DataFrame, cols: Sequence[str] = PRODUCT_SIZES) -> DataFrame:
    """Unknown category by name, missing sizes by the column median."""
    unused = ("product_name_lenght", "product_description_lenght", "product_photos_qty")
    return fill_with_median(df.drop(*unused).fillna({PT: "unknown"}), list(cols))


def approve_delivered(df: DataFrame) -> DataFrame:
    """Delivered orders without an approval time count as approved when bought."""
    fix = null_mask("order_approved_at", "delivered")
    return df.withColumn(
        "order_approved_at",
        F.when(fix, F.col("order_purchase_timestamp")).otherwise(F.col("order_approved_at")),
    )


def fill_orders(df: DataFrame, bad_ids: Sequence = ()) -> DataFrame:
    """Drop the known-bad orders, then fill approval and delivery times.

    An order without an id is kept.
    """
    rows = approve_delivered(df)
    if bad_ids:
        key = F.col("order_id")
        rows = rows.where(key.isNull() | ~key.isin(list(bad_ids)))
    return rows.withColumns(
        {
            "order_delivered_customer_date": F.coalesce(
                "order_delivered_customer_date", "order_estimated_delivery_date"
            ),
            "order_approved_at": F.coalesce("order_approved_at", "order_purchase_timestamp"),
        }
    )


def fill_payment_type(df: DataFrame) -> DataFrame:
    return df.fillna({"payment_type": "not_defined"})


def fill_geo(df: DataFrame, city_col: str = "customer_city") -> DataFrame:
    """Missing coordinates: the median of the city, then the median of everything.

    The second median is taken after the first fill. Both come from one count of the places
    of each city, so ``df`` is read twice: for the count and for the fill.
    """
    where = ["geolocation_lat", "geolocation_lng"]
    places = keep(df.groupBy(city_col, *where).agg(F.count(F.lit(1)).alias("_rows")), "places")
    city = weighted_medians(places, [city_col], where, "_rows")
    city = keep(city.withColumnsRenamed({c: f"_{c}" for c in where}), "city-medians")

    def filled(rows: DataFrame, whole: Column | None = None) -> DataFrame:
        joined = rows.join(city, city_col, "left")
        found = {c: F.coalesce(c, f"_{c}", *([] if whole is None else [whole[c]])) for c in where}
        return joined.select(*[found[c].alias(c) if c in found else F.col(c) for c in rows.columns])

    whole = weighted_medians(filled(places), [], where, "_rows")
    return filled(df, whole.select(F.struct(*where).alias("m")).scalar())
