"""The report tables: filters, totals, trends, rankings, pivots, sensitivity.

The frames coming in are the category and geography marts. As in a data-frame report,
groups with a NULL key are left out, an empty sum is 0, and a mean of mart rates is not
weighted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.lookups import PT
from tradewind.functions.scalars import exact_mean, exact_sum, place_label

STRONG, WEAK = "Strong BRL", "Weak BRL"


def _orders() -> Column:
    return F.coalesce(F.sum("order_count"), F.lit(0)).alias("order_count")


def _usd() -> Column:
    return exact_sum(F.col("total_revenue_usd")).alias("total_revenue_usd")


def _rate() -> Column:
    return exact_mean(F.col("avg_exchange_rate")).alias("avg_exchange_rate")


def _grouped(df: DataFrame, keys: Sequence[str], *measures: Column) -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*measures)


def _category(df: DataFrame) -> str:
    return "category_name" if "category_name" in df.columns else PT


def load_category(mart: DataFrame) -> DataFrame:
    """The category mart as reports read it, newest month first."""
    return mart.where(F.col("category_name").isNotNull()).select(
        "category_name", "category_name_pt", "order_month", "customer_state", "order_count",
        "total_revenue_brl", "total_revenue_usd", "avg_order_value_brl", "avg_exchange_rate",
        "exchange_rate_period",
    ).orderBy(F.desc("order_month"), "category_name", "customer_state")


def load_geo(mart: DataFrame) -> DataFrame:
    """The geography mart as reports read it, newest month first."""
    return mart.where(F.col("category_name").isNotNull()).select(
        "customer_state", "customer_city", "order_month", "category_name", "category_name_pt",
        "order_count", "total_revenue_brl", "total_revenue_usd", "avg_exchange_rate", "currency_strength",
    ).orderBy(F.desc("order_month"), "customer_state", "customer_city", "category_name")


def load_wide(mart: DataFrame) -> DataFrame:
    """All columns of an older, wide mart, newest month first."""
    return mart.where(F.col(PT).isNotNull()).orderBy(F.desc("order_month"), PT, "customer_state")


def load_customer(mart: DataFrame, n: int | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    """The item mart; with ``n`` that many rows of it, the first in the order ``order_by``."""
    if n is not None and not order_by:
        raise ValueError("a limit needs an order, or which rows it keeps is open")
    ordered = mart.orderBy(*order_by) if order_by else mart
    return ordered if n is None else ordered.limit(n)


def default_selection(df: DataFrame, col: str, n: int = 5) -> DataFrame:
    """The first ``n`` of the sorted distinct values."""
    return df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col).limit(n)


def apply_filters(
    df: DataFrame,
    months: tuple | None = None,
    categories: Sequence[str] | DataFrame | None = None,
    states: Sequence[str] | DataFrame | None = None,
    periods: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the chosen months (inclusive), categories, states and periods.

    A selection is a list, or a frame such as ``default_selection`` returns.
    """
    if months is not None:
        low, high = (F.lit(m).cast("date") for m in months)
        df = df.where(F.col("order_month").between(low, high))
    for col, chosen in (
        (_category(df), categories),
        ("customer_state", states),
        ("exchange_rate_period", periods),
    ):
        if isinstance(chosen, DataFrame):
            df = df.join(chosen, col, "left_semi")
        elif chosen is not None:
            df = df.where(F.col(col).isin(list(chosen)))
    return df


def kpis(cat: DataFrame) -> DataFrame:
    return cat.agg(
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("total_orders"),
        exact_sum(F.col("total_revenue_usd")).alias("total_revenue_usd"),
        _rate(),
        F.countDistinct(_category(cat)).alias("categories_count"),
    )


def monthly(cat: DataFrame) -> DataFrame:
    return _grouped(cat, ["order_month"], _usd(), _orders(), _rate()).orderBy("order_month")


def category_by_period(cat: DataFrame) -> DataFrame:
    return _grouped(cat, ["display_category", "exchange_rate_period"], _orders(), _usd())


def top_categories(cat: DataFrame, k: int = 10) -> DataFrame:
    rows = _grouped(cat, ["display_category"], _orders(), _usd(), _rate())
    return rows.orderBy(F.desc("total_revenue_usd"), "display_category").limit(k)


def category_trend(cat: DataFrame, name: str) -> DataFrame:
    chosen = cat.where(F.col("display_category") == name)
    return _grouped(chosen, ["order_month"], _orders(), _usd()).orderBy("order_month")


def state_sales(geo: DataFrame, k: int | None = None) -> DataFrame:
    rows = _grouped(geo, ["customer_state"], _orders(), _usd()).orderBy(
        F.desc("total_revenue_usd"), "customer_state"
    )
    return rows if k is None else rows.limit(k)


def state_category(geo: DataFrame) -> DataFrame:
    return _grouped(geo, ["customer_state", "display_category"], _orders())


def pivot_counts(
    df: DataFrame,
    index: str,
    columns: str,
    values: str,
    col_values: Sequence[str],
) -> DataFrame:
    """A matrix of summed ``values``; combinations that do not occur are 0."""
    rows = df.dropna(subset=[index, columns])
    return rows.groupBy(index).pivot(columns, list(col_values)).agg(F.sum(values)).fillna(0)


def top_cities(geo: DataFrame, k: int = 15) -> DataFrame:
    rows = _grouped(geo, ["customer_state", "customer_city"], _orders(), _usd())
    best = rows.orderBy(F.desc("total_revenue_usd"), "customer_state", "customer_city").limit(k)
    return best.withColumn("city_state", place_label(F.col("customer_city"), F.col("customer_state")))


def period_summary(cat: DataFrame) -> DataFrame:
    return _grouped(cat, ["exchange_rate_period"], _orders(), _usd(), _rate())


def elasticity(cat: DataFrame, k: int = 15) -> DataFrame:
    """Change of orders from strong to weak currency, in percent, largest first.

    0 where nothing was sold in the strong period; no rows at all unless both periods occur
    somewhere in the data. Both questions are asked of the same aggregate, so Spark reads
    ``cat`` once and reuses the exchange.
    """

    def sold(period: str) -> Column:
        count = F.when(F.col("exchange_rate_period") == period, F.col("order_count"))
        return F.coalesce(F.sum(count), F.lit(0))

    rows = _grouped(
        cat.where(F.col("exchange_rate_period").isNotNull()), ["display_category"],
        sold(STRONG).alias("strong"), sold(WEAK).alias("weak"),
    )
    both = rows.agg((F.max("strong") > 0) & (F.max("weak") > 0)).scalar()
    change = F.lit(100) * (F.col("weak") - F.col("strong")) / F.nullif(F.col("strong"), F.lit(0))
    return (
        rows.where(both)
        .select("display_category", F.coalesce(change, F.lit(0.0)).alias("elasticity"))
        .orderBy(F.desc("elasticity"), "display_category")
        .limit(k)
    )
