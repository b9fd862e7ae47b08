"""Stored marts that take in changes, against SQL that rebuilds them from changed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suite.entities import Entities
from suite.marts_queries import D3, D4, D11
from suite.registry import query
from tradewind.functions.scalars import month_of
from tradewind.plans import marts, upkeep
from tradewind.session import scratch_path
from tradewind.sources.tables import write_table

# ---- newest rows into a stored mart ----------------------------------------------------


def order_rows(e: Entities) -> DataFrame:
    rows = e.orders.select("order_id", "order_status", F.to_date("order_purchase_timestamp").alias("order_date"))
    return rows.select(
        "*", F.date_add("order_date", 10).alias("updated_at"), month_of(F.col("order_date")).alias("order_month")
    )


def newer_rows(rows: DataFrame) -> DataFrame:
    """Late and repeated news of the orders of three months, some of which move by 40 days."""
    key, day = F.col("order_id"), F.col("order_date")
    some = rows.where(day.between("1996-02-01", "1996-04-30") & (key % 3 == 0))
    moved = F.when(key % 7 == 0, F.date_add("order_date", 40)).otherwise(day)
    news = some.select(
        "order_id", F.lit("updated").alias("order_status"), moved.alias("order_date"),
        F.date_add("updated_at", F.when(key % 2 == 0, 5).otherwise(-5)).alias("updated_at"),
    ).withColumn("order_month", month_of(F.col("order_date")))
    repeated = rows.where(F.col("order_month") == "1997-01-01")
    fresh = rows.where(key % 500 == 1).withColumns({"order_id": -key, "order_status": F.lit("new")})
    return news.unionByName(repeated).unionByName(news).unionByName(fresh.where(day < "1994-01-01"))


def loaded(e: Entities) -> tuple[upkeep.MonthStore, list]:
    rows = order_rows(e)
    store = upkeep.newest_store(e.spark, scratch_path(e.spark, "orders-mart"), "orders", rows)
    upkeep.load_newest(store, "orders", rows, ["order_id"], "updated_at")
    return store, upkeep.load_newest(store, "orders", newer_rows(rows), ["order_id"], "updated_at")


NEWEST = {
    "l_rows": """SELECT order_id, order_status, order_date, order_date + 10 AS updated_at, order_month FROM e_orders""",
    "l_news": """
        SELECT order_id, 'updated' AS order_status,
               CASE WHEN order_id % 7 = 0 THEN order_date + 40 ELSE order_date END AS order_date, updated_at + 5 AS updated_at
        FROM l_rows
        WHERE order_date BETWEEN DATE '1996-02-01' AND DATE '1996-04-30' AND order_id % 3 = 0 AND order_id % 2 = 0""",
    "l_fresh": """
        SELECT -order_id AS order_id, 'new' AS order_status, order_date, updated_at FROM l_rows
        WHERE order_id % 500 = 1 AND order_date < DATE '1994-01-01'""",
    "l_now": """
        SELECT order_id, order_status, order_date, updated_at FROM l_rows
        WHERE order_id NOT IN (SELECT order_id FROM l_news)
        UNION ALL FROM l_news UNION ALL FROM l_fresh""",
}


@query(
    "r1_incremental_load",
    "SELECT *, CAST(date_trunc('month', order_date) AS DATE) AS order_month FROM l_now",
    NEWEST,
)
def _(e: Entities):
    store, _ = loaded(e)
    return store.read("orders").drop(upkeep.PRINT)


@query(
    "r1_swapped_months",
    """SELECT CAST(date_trunc('month', n.order_date) AS DATE) AS order_month,
              count(*) AS row_count,
              bool_or(EXISTS (FROM l_news c JOIN l_rows o USING (order_id)
                              WHERE date_trunc('month', n.order_date)
                                    IN (date_trunc('month', c.order_date), date_trunc('month', o.order_date)))
                      OR EXISTS (FROM l_fresh f WHERE date_trunc('month', f.order_date) = date_trunc('month', n.order_date)))
                AS swapped
       FROM l_now n GROUP BY 1""",
    NEWEST,
)
def _(e: Entities):
    """Months of the mart, and whether the second load has replaced them."""
    store, months = loaded(e)
    counts = store.read("orders").groupBy("order_month").agg(F.count("*").alias("row_count"))
    return counts.withColumn("swapped", F.col("order_month").isin(months))


# ---- the grouped marts by deltas -------------------------------------------------------


def signed(was: DataFrame, now: DataFrame) -> DataFrame:
    return was.withColumn("sign", F.lit(-1)).unionByName(now.withColumn("sign", F.lit(1)))


def changed(rows: DataFrame, where: Column, **columns: Column) -> DataFrame:
    old = rows.where(where)
    return signed(old, old.withColumns(columns))


_STORES: dict[tuple[str, str], upkeep.MonthStore] = {}


def kept_up(e: Entities) -> upkeep.MonthStore:
    """The changed store, which the queries of one session over one folder share."""
    key = e.spark.sparkContext.applicationId, e.folder
    if key not in _STORES:
        _STORES[key] = three_changes(e)
    return _STORES[key]


def three_changes(e: Entities) -> upkeep.MonthStore:
    """A store after three sets of changes: orders; items; rates together with days of orders."""
    dims = (e.products, e.customers, e.lookup)
    store = upkeep.start_sales(e.spark, scratch_path(e.spark, "sales"), e.orders, e.items, *dims, e.ind)
    key = F.col("order_id")

    orders = store.read("orders").drop("order_month")
    status = F.when(F.col("order_status") == "canceled", "delivered").otherwise("canceled")
    gone = orders.where(key % 101 == 7)
    first = changed(orders, (key % 11 == 3) & (key % 101 != 7), order_status=status).unionByName(
        gone.withColumn("sign", F.lit(-1))
    )
    upkeep.apply_sales_changes(store, first, None, None, *dims)

    items = store.read("items").drop("order_month")
    dearer = changed(items, (key % 13 == 5) & (key % 17 != 2), price=F.col("price") * 2)
    dropped = items.where((key % 17 == 2) & (F.col("order_item_id") == 3)).withColumn("sign", F.lit(-1))
    added = items.where((key % 19 == 4) & (F.col("order_item_id") == 1)).withColumns(
        {"order_item_id": F.lit(99).cast("bigint"), "sign": F.lit(1)}
    )
    upkeep.apply_sales_changes(store, None, dearer.unionByName(dropped).unionByName(added), None, *dims)

    rates = store.read("rates").drop("order_month")
    day = F.datediff("indicator_date", F.lit("1995-01-01"))
    lifted = changed(rates, day % 30 == 10, indicator_value=F.col("indicator_value") + 1)
    unknown = rates.where(day % 50 == 21).where(day % 30 != 10).withColumn("sign", F.lit(-1))
    orders = store.read("orders").drop("order_month")
    later = changed(
        orders, key % 23 == 1,
        order_purchase_timestamp=F.col("order_purchase_timestamp") + F.make_dt_interval(F.lit(45)),
    )
    upkeep.apply_sales_changes(store, later, None, lifted.unionByName(unknown), *dims)
    return store


_CHANGED = {
    "u_orders": """
        SELECT order_id, customer_id,
               CASE WHEN order_id % 11 <> 3 THEN order_status
                    WHEN order_status = 'canceled' THEN 'delivered' ELSE 'canceled' END AS order_status,
               order_date + shift AS order_date, CAST(date_trunc('month', order_date + shift) AS DATE) AS order_month
        FROM (SELECT *, CASE WHEN order_id % 23 = 1 THEN 45 ELSE 0 END AS shift FROM e_orders)
        WHERE order_id % 101 <> 7""",
    # A doubled price adds itself to the total once more; an added item is a copy of the item as it was.
    "u_items": """
        SELECT order_id, product_id,
               CASE WHEN order_id % 13 = 5 AND order_id % 17 <> 2 AND n = 1 THEN total_u + price_c * 100 ELSE total_u END AS total_u
        FROM e_items, (VALUES (1), (2)) copies(n)
        WHERE NOT (order_id % 17 = 2 AND order_item_id = 3) AND (n = 1 OR (order_id % 19 = 4 AND order_item_id = 1))""",
    "u_fx": """
        SELECT d, CASE WHEN d - DATE '1995-01-01' >= 0 AND (d - DATE '1995-01-01') % 30 = 10 THEN r + 100 ELSE r END AS r
        FROM e_fx WHERE (d - DATE '1995-01-01') % 50 <> 21 OR (d - DATE '1995-01-01') % 30 = 10""",
}


def rebuilt(sql: str) -> str:
    for name in ("orders", "items", "fx"):
        sql = sql.replace(f"e_{name}", f"u_{name}")
    return sql


query("d3_by_deltas", rebuilt(D3), _CHANGED)(lambda e: marts.category_from_cube(upkeep.stored_cube(kept_up(e))))
query("d4_by_deltas", rebuilt(D4), _CHANGED)(lambda e: marts.geo_from_cube(upkeep.stored_cube(kept_up(e))))
query("d11_by_deltas", rebuilt(D11), _CHANGED)(lambda e: upkeep.category_months(kept_up(e)))


# ---- a clustered mart ------------------------------------------------------------------


@query("r2_clustered_mart", D3)
def _(e: Entities):
    """The category mart as it comes back from files along a curve of month, category and state."""
    path = scratch_path(e.spark, "clustered")
    mart = marts.fct_category(e.items, e.orders, e.products, e.customers, e.lookup, e.ind)
    write_table(mart, path, mart.schema, curve_by=("order_month", "category_name", "customer_state"), files=8)
    return e.spark.read.schema(mart.schema).parquet(path)
