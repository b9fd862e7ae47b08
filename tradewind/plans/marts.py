"""Order, item, category and geography tables with their economic context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import scalars as S
from tradewind.functions.lookups import EN, PT, translate
from tradewind.operators.distinct import distinct_sketch
from tradewind.operators.indicators import with_fx, with_monthly

# The statuses that count as a sale.
SOLD = ("delivered", "shipped", "approved")


def _total() -> Column:
    """Price and freight of an item, in money units."""
    return S.units(F.col("price")) + S.units(F.col("freight_value"))


def _sold_orders(orders: DataFrame, customers: DataFrame, ind: DataFrame, fx_policy: str) -> DataFrame:
    """Sold orders with their customer and the rate of their day.

    Everything that depends on the order alone is attached before the items are, so the
    larger table is joined once against rows that are already complete.
    """
    sold = orders.where(F.col("order_status").isin(*SOLD)).withColumn(
        "order_date", F.to_date("order_purchase_timestamp")
    )
    return with_fx(sold.join(customers, "customer_id"), "order_date", ind, fx_policy)


def fct_orders(
    orders: DataFrame,
    items: DataFrame,
    ind: DataFrame,
    fx_policy: str = "exact",
    monthly: str | None = None,
) -> DataFrame:
    """One row per order of any status, orders without items included."""
    totals = items.groupBy("order_id").agg(
        S.unit_sum(S.units(F.col("price"))).alias("price"),
        S.unit_sum(S.units(F.col("freight_value"))).alias("freight"),
    )
    rows = orders.withColumn("order_date", F.to_date("order_purchase_timestamp")).join(
        totals, "order_id", "left"
    )
    rows = with_fx(rows, "order_date", ind, fx_policy)
    rows = with_monthly(rows, "order_date", ind, {"ipca": "ipca_month", "selic": "selic_month"}, monthly)
    total = F.col("price") + F.col("freight")
    rate = F.nullif(F.col("usd_brl_rate").cast("double"), F.lit(0.0))
    return rows.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_date",
        "order_purchase_timestamp",
        F.col("price").cast("double").alias("order_value_brl"),
        F.col("freight").cast("double").alias("freight_value_brl"),
        total.cast("double").alias("total_order_value_brl"),
        "usd_brl_rate",
        S.to_cents(total.cast("double") / rate).alias("total_order_value_usd"),
        "ipca_month",
        "selic_month",
    )


def fct_customer_items(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    ind: DataFrame,
    fx_policy: str = "exact",
    monthly: str | None = None,
) -> DataFrame:
    """One row per sold item, with its customer and the economy on that day."""
    who = customers.select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"
    )
    sold = _sold_orders(
        orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
        who, ind, fx_policy,
    )
    sold = with_monthly(sold, "order_date", ind, {"ipca": "inflation_rate", "selic": "interest_rate"}, monthly)
    lines = (
        items.select("order_id", "product_id", "price", "freight_value")
        .join(sold, "order_id")
        .join(products.select("product_id", PT), "product_id", "left")
    )
    rate, interest = F.col("usd_brl_rate"), F.col("interest_rate")
    return lines.select(
        *who.columns,
        "order_id",
        "order_date",
        "order_status",
        "product_id",
        PT,
        "price",
        "freight_value",
        S.from_units(_total()).alias("total_item_value"),
        "usd_brl_rate",
        "inflation_rate",
        "interest_rate",
        S.to_cents(S.dollars(_total(), rate)).alias("total_item_value_usd"),
        S.bucket(rate, *S.FX_LIMITS, S.ROW_FX_LABELS).alias("exchange_rate_category"),
        S.bucket(interest, *S.INTEREST_LIMITS, S.ROW_INTEREST_LABELS).alias("interest_rate_category"),
    )


# What the grouped marts add up: name, column, and whether it needs units first.
AMOUNTS = {"total": ("total", False), "rate": ("usd_brl_rate", True)}
WIDE_AMOUNTS = AMOUNTS | {
    "weight": ("product_weight_g", True),
    "inflation": ("inflation_rate", True),
    "interest": ("interest_rate", True),
}
# Whose different values a group can keep a sketch of.
REACH = {"orders": "order_id", "customers": "customer_unique_id"}
BY_PLACE = ("customer_state", "customer_city", "order_month", "category_name", "category_name_pt")
WIDE_BY_PLACE = ("customer_state", "customer_city", "order_month", PT)


def sales_cube(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    lookup: DataFrame | None,
    ind: DataFrame,
    keys: Sequence[str] = BY_PLACE,
    wide: bool = False,
    how: str = "left",
    fx_policy: str = "exact",
    reach: bool = False,
) -> DataFrame:
    """Counts and exact sums of sold items per ``keys``: all that the grouped marts need.

    One pass over the items; coarser marts come from the result by adding it up further.
    The wide form keeps the original category name and adds weight, inflation and interest.
    With ``reach`` a group also keeps mergeable sketches of its orders and customers.
    """
    who = ["customer_id", "customer_city", "customer_state", *["customer_unique_id"] * reach]
    sold = _sold_orders(
        orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
        customers.select(*who),
        ind, fx_policy,
    )
    if wide:
        sold = with_monthly(sold, "order_date", ind, {"ipca": "inflation_rate", "selic": "interest_rate"})
        named = products.select("product_id", PT, "product_weight_g")
    else:
        both = translate(products.select("product_id", PT), lookup, PT, EN, default=None)
        named = both.select(
            "product_id", F.coalesce(EN, PT).alias("category_name"), F.col(PT).alias("category_name_pt"),
            F.lit(True).alias("product_known"),
        )
    lines = (
        items.select("order_id", "product_id", "price", "freight_value")
        .join(sold, "order_id")
        .join(named, "product_id", how)
        .withColumns({"order_month": S.month_of(F.col("order_date")), "total": _total()})
        .withColumn("usd", S.dollars(F.col("total"), F.col("usd_brl_rate")))
    )
    sums = [
        F.count(F.lit(1)).alias("order_count"),
        S.fine_sum(F.col("usd")).alias("usd_sum"),
        F.count("usd").alias("usd_n"),
    ]
    for name, (column, raw) in (WIDE_AMOUNTS if wide else AMOUNTS).items():
        counted = S.units(F.col(column)) if raw else F.col(column)
        sums += [S.unit_sum(counted).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]
    if reach:
        sums += [distinct_sketch(F.col(c)).alias(f"{n}_sketch") for n, c in REACH.items()]
    return lines.groupBy(*keys).agg(*sums)


def _coarser(cube: DataFrame, *keys: str) -> DataFrame:
    """The cube without its city, which is counted instead."""
    sums = [F.sum(c).alias(c) for c in cube.columns if c.endswith(("_sum", "_n", "_count"))]
    return cube.groupBy(*keys).agg(*sums, F.count("customer_city").alias("unique_cities"))


def _sum(name: str) -> Column:
    return F.col(f"{name}_sum")


def _mean(name: str) -> Column:
    return S.mean_of(_sum(name), F.col(f"{name}_n"))


def _measures(*which: str) -> list[Column]:
    measures = {
        "avg_order_value_brl": lambda: S.rounded(_mean("total")),
        "total_revenue_brl": lambda: S.rounded(_sum("total")),
        "avg_product_weight": lambda: S.rounded(_mean("weight")),
        "avg_exchange_rate": lambda: S.rounded(_mean("rate"), 4),
        "avg_inflation": lambda: S.rounded(_mean("inflation")),
        "avg_interest_rate": lambda: S.rounded(_mean("interest")),
        "avg_order_value_usd": lambda: S.rounded(_mean("usd")),
        "total_revenue_usd": lambda: S.rounded(_sum("usd")),
        "exchange_rate_period": lambda: S.bucket(_mean("rate"), *S.FX_LIMITS, S.FX_LABELS),
        "currency_strength": lambda: S.bucket(_mean("rate"), S.FX_LIMITS[0], None, S.STRENGTH_LABELS),
        "interest_rate_period": lambda: S.bucket(
            _mean("interest"), *S.INTEREST_LIMITS, S.INTEREST_LABELS
        ),
    }
    return [measures[name]().alias(name) if name in measures else F.col(name) for name in which]


def _category(groups: DataFrame) -> DataFrame:
    return groups.select(
        "category_name", "category_name_pt", "order_month", "customer_state",
        *_measures(
            "order_count", "avg_order_value_brl", "total_revenue_brl", "avg_exchange_rate",
            "total_revenue_usd", "exchange_rate_period",
        ),
    )


def category_from_cube(cube: DataFrame) -> DataFrame:
    known = cube.where(F.col("category_name_pt").isNotNull())
    return _category(_coarser(known, "category_name", "category_name_pt", "order_month", "customer_state"))


def category_wide_from_cube(cube: DataFrame) -> DataFrame:
    groups = _coarser(cube.where(F.col(PT).isNotNull()), PT, "order_month", "customer_state")
    return groups.select(
        PT, "order_month", "customer_state",
        *_measures(
            "order_count", "unique_cities", "avg_order_value_brl", "total_revenue_brl",
            "avg_product_weight", "avg_exchange_rate", "avg_inflation", "avg_interest_rate",
            "avg_order_value_usd", "total_revenue_usd", "exchange_rate_period", "interest_rate_period",
        ),
    )


def category_month_from_cube(groups: DataFrame) -> DataFrame:
    return groups.select(
        "category_name", "order_month",
        *_measures(
            "order_count", "total_revenue_brl", "avg_exchange_rate", "total_revenue_usd", "exchange_rate_period"
        ),
    )


def geo_from_cube(cube: DataFrame) -> DataFrame:
    return cube.select(
        *BY_PLACE,
        *_measures(
            "order_count", "total_revenue_brl", "avg_exchange_rate", "total_revenue_usd", "currency_strength"
        ),
    )


def geo_wide_from_cube(cube: DataFrame) -> DataFrame:
    mart = cube.select(
        *WIDE_BY_PLACE,
        *_measures(
            "order_count", "total_revenue_brl", "avg_order_value_brl", "avg_exchange_rate",
            "avg_inflation", "avg_interest_rate", "total_revenue_usd", "avg_order_value_usd",
            "exchange_rate_period", "interest_rate_period",
        ),
    )
    return mart.withColumnsRenamed(
        {
            "avg_interest_rate": "avg_selic",
            "exchange_rate_period": "currency_strength",
            "interest_rate_period": "interest_environment",
        }
    )


def fct_category(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    lookup: DataFrame | None,
    ind: DataFrame,
    wide: bool = False,
    by_state: bool = True,
    fx_policy: str = "exact",
) -> DataFrame:
    """Sales per category, month and state (or category and month only).

    ``order_count`` counts items. The wide form keeps the original category name only and
    adds weights, cities, inflation and interest; it needs no lookup.
    """
    known = products.where(F.col(PT).isNotNull())
    if wide:
        return category_wide_from_cube(
            sales_cube(items, orders, known, customers, None, ind, WIDE_BY_PLACE, True, "inner", fx_policy)
        )
    if not by_state:
        # The documented simpler form keeps items whose category is unknown.
        keys = ("category_name", "order_month")
        groups = sales_cube(items, orders, products, customers, lookup, ind, keys, False, "inner", fx_policy)
        return category_month_from_cube(groups)
    keys = ("category_name", "category_name_pt", "order_month", "customer_state")
    return _category(
        sales_cube(items, orders, known, customers, lookup, ind, keys, False, "inner", fx_policy)
    )


def fct_geo(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    lookup: DataFrame | None,
    ind: DataFrame,
    wide: bool = False,
    fx_policy: str = "exact",
) -> DataFrame:
    """Sales per state, city, month and category; unknown categories form their own group."""
    keys, finish = (WIDE_BY_PLACE, geo_wide_from_cube) if wide else (BY_PLACE, geo_from_cube)
    return finish(
        sales_cube(items, orders, products, customers, lookup, ind, keys, wide, "left", fx_policy)
    )
