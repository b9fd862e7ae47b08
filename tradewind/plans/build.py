"""The whole run: staging, marts, checks, report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tradewind.operators import quality, staging
from tradewind.operators.profile import row_counts
from tradewind.plans import marts
from tradewind.plans.checks import STAGING_CHECKS
from tradewind.session import keep
from tradewind.sources.tables import write_table

# Mart, and the columns its files are clustered by.
LAYOUT = {
    "fct_orders_with_economics": ("order_date",),
    "fct_customer_purchases_economics": ("order_date",),
    "fct_category_performance_economics": ("order_month", "category_name", "customer_state"),
    "fct_geographic_sales_economics": ("order_month", "customer_state", "customer_city"),
}


def stage(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The staging views of the raw tables."""
    return {
        "stg_orders": staging.stg_orders(raw["orders"]),
        "stg_order_items": staging.stg_order_items(raw["order_items"]),
        "stg_customers": staging.stg_customers(raw["customers"]),
        "stg_products": staging.stg_products(raw["products"]),
        "stg_payments": staging.strict_payments(raw["payments"]),
        "stg_indicators": staging.stg_indicators(raw["indicators"]),
    }


def build_marts(
    stg: Mapping[str, DataFrame], lookup: DataFrame, fx_policy: str = "exact"
) -> dict[str, DataFrame]:
    """The four marts. The grouped ones share one stored pass over the items."""
    orders, items, customers = stg["stg_orders"], stg["stg_order_items"], stg["stg_customers"]
    products, ind = stg["stg_products"], stg["stg_indicators"]
    cube = keep(
        marts.sales_cube(items, orders, products, customers, lookup, ind, fx_policy=fx_policy), "sales-cube"
    )
    return {
        "fct_orders_with_economics": marts.fct_orders(orders, items, ind, fx_policy),
        "fct_customer_purchases_economics": marts.fct_customer_items(
            customers, orders, items, products, ind, fx_policy
        ),
        "fct_category_performance_economics": marts.category_from_cube(cube),
        "fct_geographic_sales_economics": marts.geo_from_cube(cube),
    }


def run_all(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    lookup: DataFrame,
    out: str,
    fx_policy: str = "exact",
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Build and store the marts, run the declared checks, report.

    Returns the stored marts, the check results and the one-row report.
    """
    stg = stage(raw)
    stored = {}
    for name, df in build_marts(stg, lookup, fx_policy).items():
        write_table(df, f"{out}/{name}", df.schema, cluster_by=LAYOUT[name], stamp="updated_at")
        stored[name] = spark.read.parquet(f"{out}/{name}")
    results = quality.run_checks(stg, STAGING_CHECKS)
    return stored, results, quality.run_report(row_counts(stored, total=False), results)
