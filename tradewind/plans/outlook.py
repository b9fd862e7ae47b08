"""What the documentation plans around the marts: upserts, drill-down, comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.lookups import EN
from tradewind.functions.scalars import exact_sum, unit_sum, units
from tradewind.operators.medians import medians


def newest_per_key(old: DataFrame, new: DataFrame, keys: Sequence[str], updated_at: str) -> DataFrame:
    """Incremental load: of the rows of each key in both frames, the one updated last.

    An aggregate, not a window: a key with very many versions is reduced before the shuffle.
    On equal times a new row wins over an old one, and of two from the same frame the greater
    one, so the outcome does not depend on row order.
    """
    columns = old.columns
    rest = [c for c in columns if c not in keys and c != updated_at]
    marked = [df.select(*columns, F.lit(i).alias("__new")) for i, df in enumerate((old, new))]
    latest = F.max(F.struct(updated_at, "__new", *rest)).alias("latest")
    rows = marked[0].unionByName(marked[1])
    return rows.groupBy(*keys).agg(latest).select(*keys, "latest.*").select(*columns)


def drill_down(customer_items: DataFrame) -> DataFrame:
    """Items and revenue per state, per city and per customer, one level below the other.

    ``level`` is 0 for a customer, 1 for a city, 3 for a state and 7 for everything.
    """
    return (
        customer_items.rollup("customer_state", "customer_city", "customer_id")
        .agg(
            F.grouping_id().alias("level"),
            F.count(F.lit(1)).alias("order_count"),
            unit_sum(units(F.col("total_item_value"))).cast("double").alias("total_revenue_brl"),
        )
    )


def year_over_year(cat: DataFrame) -> DataFrame:
    """Orders and revenue per month next to the same month of the year before."""
    months = cat.groupBy("order_month").agg(
        F.sum("order_count").alias("order_count"),
        exact_sum(F.col("total_revenue_usd")).alias("total_revenue_usd"),
    )
    before = months.select(
        F.add_months("order_month", 12).alias("order_month"),
        F.col("order_count").alias("order_count_before"),
        F.col("total_revenue_usd").alias("total_revenue_usd_before"),
    )
    return months.join(before, "order_month", "left")


def rate_correlation(cat: DataFrame) -> DataFrame:
    """Correlation of monthly revenue and exchange rate, per category."""
    return cat.groupBy("category_name").agg(
        F.corr("total_revenue_usd", "avg_exchange_rate").alias("correlation"),
        F.count_if(F.col("avg_exchange_rate").isNotNull()).alias("observations"),
    )


def delivery_days(facts: DataFrame, category: str = EN) -> DataFrame:
    """Mean and median days from purchase to delivery, per category."""
    days = facts.select(
        category,
        F.datediff("order_delivered_customer_date", "order_purchase_timestamp").alias("median_days"),
    )
    means = days.where(F.col(category).isNotNull()).groupBy(category).agg(
        F.round(F.avg("median_days"), 2).alias("mean_days")
    )
    return means.join(medians(days, [category], ["median_days"]), category)


def dim_date(df: DataFrame, date_col: str) -> DataFrame:
    """One row per day from the first to the last date of a column."""
    bounds = df.agg(F.to_date(F.min(date_col)).alias("a"), F.to_date(F.max(date_col)).alias("b"))
    day = F.col("date_day")
    return bounds.select(F.explode(F.sequence("a", "b")).alias("date_day")).select(
        day,
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        (F.weekday(day) + 1).cast("bigint").alias("iso_weekday"),
        F.trunc(day, "MM").alias("month_start"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )
