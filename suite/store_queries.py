"""Databases, load times, samples, and the values of a whole run, as they come back from storage."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.entities import Entities
from suite.marts_queries import MARTS, d3, d4, plain_times
from suite.registry import query
from tradewind.operators import profile, quality
from tradewind.plans import build
from tradewind.session import scratch_path
from tradewind.sources import tables


@query(
    "s9_s10_database",
    """SELECT 'fct_category' AS table_name, count(*) AS row_count FROM m_cat
       UNION ALL SELECT 'fct_geo', count(*) FROM m_geo""",
    MARTS,
)
def _(e: Entities):
    """Two marts in a new database, beside a table of another name, as the database lists them."""
    db = f"shop_{uuid.uuid4().hex}"
    tables.ensure_database(e.spark, db, scratch_path(e.spark, "database"))
    tables.ensure_database(e.spark, db)  # it is there already
    for name, df in {"fct_category": d3(e), "fct_geo": d4(e), "other": e.lookup}.items():
        tables.materialize(df, f"{db}.{name}", "table")
    named = [r.table_name for r in tables.list_tables(e.spark, db, r"fct\_%").collect()]
    return profile.row_counts({n: e.spark.table(f"{db}.{n}") for n in named}, total=False)


query(
    "x13_load_time",
    "SELECT order_id, order_status, TIMESTAMP '2024-01-02 03:04:05' AS loaded_at FROM e_orders",
)(
    lambda e: plain_times(
        tables.with_load_time(e.orders.select("order_id", "order_status"), at=F.lit("2024-01-02 03:04:05").cast("timestamp"))
    )
)


@query(
    "s15_sample_members",
    "SELECT CAST(50 AS BIGINT) AS rows_drawn, CAST(50 AS BIGINT) AS different_rows, CAST(50 AS BIGINT) AS known_rows",
)
def _(e: Entities):
    """A sample has as many rows as asked for, none twice, all from the table."""
    orders = e.orders.select("order_id", "order_status")
    drawn = profile.sample_rows(orders, 50, seed=7)
    known = drawn.join(orders.withColumn("known", F.lit(1)), ["order_id", "order_status"], "left")
    return known.agg(
        F.count("*").alias("rows_drawn"), F.countDistinct("order_id").alias("different_rows"), F.count("known").alias("known_rows")
    )


@query("q11_newest_mart", "SELECT 'fct_geo' AS table_name, true AS recently_updated")
def _(e: Entities):
    """The mart that was written last, and just now."""
    paths = {n: scratch_path(e.spark, n) for n in ("fct_category", "fct_geo")}
    for (_, path), mart in zip(paths.items(), (d3(e), d4(e)), strict=True):
        tables.write_table(mart, path, mart.schema)
    return quality.recency(e.spark, paths, F.current_timestamp()).drop("minutes_since_update")


STORED = {
    "fct_orders_with_economics": ("m_orders", ("total_order_value_brl", "total_order_value_usd")),
    "fct_customer_purchases_economics": ("m_items", ("total_item_value", "total_item_value_usd")),
    "fct_category_performance_economics": ("m_cat", ("total_revenue_brl", "total_revenue_usd")),
    "fct_geographic_sales_economics": ("m_geo", ("total_revenue_brl", "total_revenue_usd")),
}
TOTALS = " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, count(*) AS row_count,
               CAST(sum(CAST(round({brl} * 10000) AS BIGINT)) AS BIGINT) AS brl_units,
               CAST(sum(CAST(round({usd} * 100) AS BIGINT)) AS BIGINT) AS usd_cents,
               count({usd}) AS rows_with_usd
        FROM {source}"""
    for name, (source, (brl, usd)) in STORED.items()
)


@query("d1_d4_stored_totals", TOTALS, MARTS)
def _(e: Entities):
    """Rows and money in each mart that the whole run has stored."""
    raw = {
        "orders": e.raw_orders, "order_items": e.raw_items, "customers": e.raw_customers,
        "products": e.raw_products, "payments": e.raw_payments, "indicators": e.raw_indicators,
    }
    stored, _, _ = build.run_all(e.spark, raw, e.lookup, scratch_path(e.spark, "run"))

    def totals(name: str) -> DataFrame:
        brl, usd = STORED[name][1]
        whole = lambda c, n: F.sum(F.rint(F.col(c) * n).cast("bigint"))
        return stored[name].agg(
            F.count("*").alias("row_count"), whole(brl, 10000).alias("brl_units"), whole(usd, 100).alias("usd_cents"),
            F.count(usd).alias("rows_with_usd"),
        ).select(F.lit(name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, map(totals, STORED))
