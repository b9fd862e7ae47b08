"""Marts that are kept up to date by what has changed, instead of being rebuilt."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.scalars import month_of
from tradewind.operators.indicators import FX_SERIES
from tradewind.plans import marts
from tradewind.plans.outlook import newest_per_key
from tradewind.session import keep
from tradewind.sources.months import MONTH, MonthStore

PRINT = "row_print"


def _months_in(*frames: DataFrame) -> list[dt.date | None]:
    """The different months of frames that have the column: at most as many as the calendar has."""
    found = reduce(DataFrame.unionByName, [df.select(MONTH).distinct() for df in frames]).distinct().collect()
    return sorted((r[0] for r in found), key=lambda m: (m is not None, m or dt.date.min))


# ---- newest row per key ----------------------------------------------------------------


def newest_store(spark: SparkSession, root: str, table: str, like: DataFrame) -> MonthStore:
    """A store of one table of the columns of ``like``, which has ``order_month``."""
    schema = T.StructType([*like.schema.fields, T.StructField(PRINT, T.LongType())])
    return MonthStore(spark, root, {table: schema})


def load_newest(store: MonthStore, table: str, new: DataFrame, keys: Sequence[str], updated_at: str) -> list[dt.date | None]:
    """Take new rows into a stored table that holds one row per key, the one updated last.

    The result is that of `newest_per_key` over the stored and the new rows. Of the stored table
    the keys, times, and prints of rows are looked at; a new row counts if its key is new, if it is
    later than the stored row, or if it is as late and differs. Only the months that such rows come
    to, or leave, are read in full and swapped. Returns those months; none if nothing changed.
    """
    schema = store.schemas[table]
    columns = [c for c in schema.names if c != PRINT]
    rest = [c for c in columns if c not in keys and c != updated_at]
    # As in newest_per_key, of equal times the greatest row; then a print of the row.
    latest = F.max(F.struct(updated_at, *rest)).alias("latest")
    new = new.select(*columns).groupBy(*keys).agg(latest).select(*keys, "latest.*").select(*columns)
    new = new.withColumn(PRINT, F.xxhash64(*columns))
    held = store.read(table).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col(updated_at).alias("_at"), F.col(PRINT).alias("_print"),
        F.col(MONTH).alias("_month"), F.lit(True).alias("_held"),
    )
    same_key = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    at = F.col(updated_at)
    later = F.col("_at").isNull() & at.isNotNull() | (at > F.col("_at"))
    counts = F.col("_held").isNull() | later | (at.eqNullSafe(F.col("_at")) & (F.col(PRINT) != F.col("_print")))
    changed = keep(new.join(held, same_key, "left").where(F.coalesce(counts, F.lit(False))), "changed")
    left = changed.where("_held").select(F.col("_month").alias(MONTH))
    months = _months_in(changed, left)
    if months:
        ids = changed.select(*[F.col(k).alias(f"_{k}") for k in keys])
        rows = store.read(table, months).join(ids, same_key, "left_anti")
        store.swap({table: (rows.unionByName(changed.select(*schema.names)), months)})
    return months


# ---- the sales cube --------------------------------------------------------------------

KEYS = (*marts.BY_PLACE, "product_known")
SALES_TABLES = ("orders", "items", "rates", "cube")
SIGN = "sign"


def _monthly(orders: DataFrame) -> DataFrame:
    return orders.withColumn(MONTH, month_of(F.to_date("order_purchase_timestamp")))


def _with_order_month(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items in the month of their order; without one if the order is not known (yet)."""
    months = orders.groupBy("order_id").agg(F.min(MONTH).alias(MONTH))
    return items.join(months, "order_id", "left")


def _cube(orders: DataFrame, items: DataFrame, rates: DataFrame, products, customers, lookup) -> DataFrame:
    plain = [df.drop(MONTH) for df in (items, orders)]
    ind = rates.select(F.lit(FX_SERIES).alias("series_name"), "indicator_date", "indicator_value")
    return marts.sales_cube(*plain, products, customers, lookup, ind, KEYS)


def _measures(cube: DataFrame) -> list[str]:
    return [c for c in cube.columns if c not in KEYS]


def start_sales(
    spark: SparkSession,
    root: str,
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    lookup: DataFrame,
    ind: DataFrame,
) -> MonthStore:
    """A store of orders, items, exchange rates and the sales cube, each in months of the orders.

    ``orders`` has one row per order_id. What the cube needs of them is stored; items of unknown
    orders are held without a month until their order comes.
    """
    orders = _monthly(orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp"))
    items = items.select("order_id", "order_item_id", "product_id", "price", "freight_value")
    rates = ind.where(F.col("series_name") == FX_SERIES).select("indicator_date", "indicator_value")
    rates = rates.withColumn(MONTH, month_of(F.col("indicator_date")))
    cube = _cube(orders, items, rates, products, customers, lookup)
    frames = dict(zip(SALES_TABLES, (orders, _with_order_month(items, orders), rates, cube), strict=True))
    # Sums may grow past the width that one build gives them.
    widened = [
        T.StructField(f.name, T.DecimalType(38, f.dataType.scale) if isinstance(f.dataType, T.DecimalType) else f.dataType)
        for f in cube.schema.fields
    ]
    schemas = {name: df.schema for name, df in frames.items()} | {"cube": T.StructType(widened)}
    sorted_by = {"orders": ["order_id"], "items": ["order_id"], "rates": ["indicator_date"], "cube": list(marts.BY_PLACE[:2])}
    store = MonthStore(spark, root, schemas, sorted_by)
    store.swap({name: (df, None) for name, df in frames.items()})
    return store


def _applied(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows after signed changes: +1 adds a row, -1 takes an equal one away.

    Taking away a row that is not there raises.
    """
    columns = [c for c in rows.columns]
    both = rows.withColumn(SIGN, F.lit(1)).unionByName(changes.select(*columns, F.col(SIGN).cast("int").alias(SIGN)))
    missing = F.raise_error(F.lit("a change takes away a row that is not stored")).cast("int")
    left = both.groupBy(*columns).agg(F.sum(SIGN).cast("int").alias("n"))
    times = F.when(F.col("n") < 0, missing).otherwise(F.col("n"))
    return left.where(F.col("n") != 0).select(*columns, F.explode(F.array_repeat(F.lit(1), times)).alias("_")).drop("_")


def apply_sales_changes(
    store: MonthStore,
    orders: DataFrame | None,
    items: DataFrame | None,
    rates: DataFrame | None,
    products: DataFrame,
    customers: DataFrame,
    lookup: DataFrame,
) -> list[dt.date | None]:
    """Bring the store up to date after signed changes of orders, items and exchange rates.

    Each frame has the columns of its table (without ``order_month``) and ``sign``: -1 for a row as it
    was, +1 for a row as it is now; None means no change. The cube is corrected by the difference
    of two small cubes, over the orders that a change touches: as they were, taken off, and as they
    are, put on. An order is touched by a change of itself, of its items, or of the rate of its day.

    Read are the changed months of orders and items, the touched groups of the cube, and the order
    ids of all orders if items change (to find their months). Products and customers must be those
    of before; a change of theirs needs a new start. Returns the months whose groups changed.
    """
    spark = store.spark
    stored_rates = store.read("rates")

    def of(changes: DataFrame | None, table: str) -> DataFrame:
        if changes is None:
            empty = T.StructType([*store.schemas[table].fields, T.StructField(SIGN, T.IntegerType())])
            return spark.createDataFrame([], empty)
        if table == "orders":
            changes = _monthly(changes)
        elif table == "rates":
            changes = changes.withColumn(MONTH, month_of(F.col("indicator_date")))
        else:
            changes = changes.withColumn(MONTH, F.lit(None).cast("date"))
        return keep(changes.select(*store.schemas[table].names, SIGN), f"{table}-changes")

    d_orders, d_items, d_rates = of(orders, "orders"), of(items, "items"), of(rates, "rates")
    ids = keep(d_orders.select("order_id").unionByName(d_items.select("order_id")).distinct(), "changed-ids")
    frames = [d_orders, d_rates]
    if items is not None:
        asked = d_items.select("order_id").distinct()
        frames.append(store.read("orders").select("order_id", MONTH).join(asked, "order_id", "left_semi"))
    months = [m for m in _months_in(*frames) if m is not None]

    old_orders, old_items = store.read("orders", [*months, None]), store.read("items", [*months, None])
    # Orders that a change touches, and whether they or their items themselves change. A change of a
    # day touches the same orders before and after: those that move are changed. The big tables meet
    # this list once; all that follows reads the rows found.
    days = d_rates.select(F.col("indicator_date").alias("order_date")).distinct()
    dated = old_orders.withColumn("order_date", F.to_date("order_purchase_timestamp"))
    by_day = dated.join(days, "order_date", "left_semi").select("order_id", F.lit(False).alias("changed"))
    marks = by_day.unionByName(ids.withColumn("changed", F.lit(True)))
    marks = keep(marks.groupBy("order_id").agg(F.max("changed").alias("changed")), "touched")
    touched_orders = keep(old_orders.join(marks, "order_id"), "touched-orders")
    touched_items = keep(old_items.join(marks, "order_id"), "touched-items")

    def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows that change themselves, and others that are touched."""
        return rows.where("changed").drop("changed"), rows.where("NOT changed").drop("changed")

    (own_orders, near_orders), (own_items, near_items) = split(touched_orders), split(touched_items)
    # Only changed rows are matched one by one; all others stay as they are.
    new_orders = keep(_applied(own_orders.select(*old_orders.columns), d_orders), "changed-orders")
    now = _applied(own_items.select(*old_items.columns).drop(MONTH), d_items.drop(MONTH))
    new_items = keep(_with_order_month(now, new_orders), "changed-items")
    other_orders, other_items = (df.join(ids, "order_id", "left_anti") for df in (old_orders, old_items))
    all_orders, all_items = other_orders.unionByName(new_orders), other_items.unionByName(new_items)
    new_rates = _applied(stored_rates, d_rates)

    dims = (products, customers, lookup)
    before = _cube(touched_orders.drop("changed"), touched_items.drop("changed"), stored_rates, *dims)
    after = _cube(near_orders.unionByName(new_orders), near_items.unionByName(new_items), new_rates, *dims)
    negated = before.select(*KEYS, *[(-F.col(c)).alias(c) for c in _measures(before)])
    names = _measures(before)
    delta = after.unionByName(negated).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in names])
    # A group without items has sums of nothing, or none at all.
    delta = keep(delta.where(" or ".join(f"coalesce({c}, 0) != 0" for c in names)), "delta")
    touched = _months_in(delta)
    groups = store.read("cube", touched).unionByName(delta.select(*store.schemas["cube"].names))
    groups = groups.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in names])
    # A sum of nothing is NULL, not 0, also after everything has been taken off.
    groups = groups.withColumns({f"{m}_sum": F.when(F.col(f"{m}_n") != 0, F.col(f"{m}_sum")) for m in ("usd", "total", "rate")})
    broken = F.raise_error(F.lit("a group of the cube has less than nothing")).cast("boolean")
    groups = groups.where(F.when(F.col("order_count") < 0, broken).otherwise(F.col("order_count") > 0))

    contents: dict[str, tuple[DataFrame, list]] = {}
    if orders is not None:
        own = _months_in(d_orders)
        contents["orders"] = (_within(all_orders, own), own)
    # Items move with their orders, so their months follow from the changed ones, before and after.
    own = _months_in(own_items, new_items)
    if own:
        contents["items"] = (_within(all_items, own), own)
    if rates is not None:
        own = _months_in(d_rates)
        contents["rates"] = (_within(new_rates, own), own)
    if touched:
        contents["cube"] = (groups, touched)
    if contents:
        store.swap(contents)
    return touched


def _within(rows: DataFrame, months: Sequence[dt.date | None]) -> DataFrame:
    known = F.col(MONTH).isin([m for m in months if m is not None])
    return rows.where(known | F.col(MONTH).isNull() if None in months else known)


def stored_cube(store: MonthStore, months: Sequence[dt.date | None] | None = None) -> DataFrame:
    """The cube of the grouped marts, for `category_from_cube` and `geo_from_cube`."""
    cube = store.read("cube", months)
    return cube.groupBy(*marts.BY_PLACE).agg(*[F.sum(c).alias(c) for c in _measures(cube)])


def category_months(store: MonthStore) -> DataFrame:
    """The mart of category and month only, of items with a known product."""
    cube = store.read("cube").where("product_known")
    groups = cube.groupBy("category_name", MONTH).agg(*[F.sum(c).alias(c) for c in _measures(cube)])
    return marts.category_month_from_cube(groups)
