"""Reading raw entities, writing and naming tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.session import keep
from tradewind.sources.curve import along_curve


class Entity(NamedTuple):
    """A raw table: its files, its key columns and its columns, all read as text.

    ``multi_line`` says that quoted values may hold line ends; such a file is read by one
    task, any other is split.
    """

    path: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    multi_line: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


# File name pattern, keys and columns of each raw entity.
ENTITIES = {
    "raw_customers": Entity(
        "*customers_dataset.csv", ("customer_id",),
        ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
    ),
    "raw_geolocation": Entity(
        "*geolocation_dataset.csv", (),
        ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
         "geolocation_state"),
    ),
    "raw_order_items": Entity(
        "*order_items_dataset.csv", ("order_id", "order_item_id"),
        ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
         "freight_value"),
    ),
    "raw_payments": Entity(
        "*order_payments_dataset.csv", ("order_id", "payment_sequential"),
        ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
    ),
    "raw_order_reviews": Entity(
        "*order_reviews_dataset.csv", ("review_id",),
        ("review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
         "review_creation_date", "review_answer_timestamp"),
        multi_line=True,
    ),
    "raw_orders": Entity(
        "*orders_dataset.csv", ("order_id",),
        ("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
         "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"),
    ),
    "raw_products": Entity(
        "*products_dataset.csv", ("product_id",),
        ("product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
         "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
         "product_width_cm"),
    ),
    "raw_sellers": Entity(
        "*sellers_dataset.csv", ("seller_id",),
        ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    ),
    "raw_product_category_name_translation": Entity(
        "*category_name_translation.csv", ("product_category_name",),
        ("product_category_name", "product_category_name_english"),
    ),
}

# Logical source name and the table that holds it.
SOURCES = {
    "orders": "public-orders",
    "order_items": "public-Order_Items",
    "payments": "public-order_payments",
    "customers": "public-Customers",
    "products": "public-products",
    "sellers": "public-sellers",
    "reviews": "public-reviews",
    "geolocation": "public-Geolocation",
    "indicators": "bcb_economic_indicators",
    "translation": "public-product_category",
}

INDICATOR_SCHEMA = "data DATE, valor DOUBLE, series_name STRING, series_id BIGINT, extracted_at TIMESTAMP"


def _csv(spark: SparkSession, multi_line: bool):
    return spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')


def _by_header(spark: SparkSession, path: str, multi_line: bool, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by their names in the header, in whatever order they stand.

    Further columns are left out. A missing one raises, and so does a file whose header
    differs from that of the first.
    """
    types = {f.name: f.dataType for f in schema.fields}
    header = _csv(spark, multi_line).csv(path).columns
    if missing := [c for c in types if c not in header]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    as_read = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    rows = _csv(spark, multi_line).option("enforceSchema", False).schema(as_read).csv(path)
    return rows.select(*[F.col(f"`{c}`") for c in types])


def read_entities(
    spark: SparkSession, root: str, specs: Mapping[str, Entity] = ENTITIES
) -> dict[str, DataFrame]:
    """The raw entities below ``root``, every column as text."""
    return {
        name: _by_header(spark, f"{root}/{spec.path}", spec.multi_line, spec.schema)
        for name, spec in specs.items()
    }


def is_time_column(name: str) -> bool:
    return "date" in name.lower() or "timestamp" in name.lower()


def load_csv(
    spark: SparkSession,
    path: str,
    table: str,
    mode: str = "overwrite",
    schema: T.StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Load a headed CSV file as a Parquet table at the path ``table``.

    Columns named like dates become timestamps (unreadable values NULL). The others get the
    type their values have, which costs a pass of its own unless a ``schema`` is given; its
    columns are found by name. With ``multi_line`` quoted values may hold line ends, and each
    file is read by one task.
    """
    reader = _csv(spark, multi_line)
    found = schema or reader.option("inferSchema", True).csv(path).schema
    as_read = T.StructType(
        [T.StructField(f.name, T.StringType() if is_time_column(f.name) else f.dataType) for f in found.fields]
    )
    raw = _by_header(spark, path, multi_line, as_read)
    times = {c: F.try_to_timestamp(F.col(f"`{c}`")) for c in raw.columns if is_time_column(c)}
    (raw.withColumns(times) if times else raw).write.mode(mode).parquet(table)
    return spark.read.parquet(table)


def jdbc_options(
    url: str,
    table: str,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Options of a full-table scan, split by ranges of a numeric key where one is given."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000"}
    if column is not None:
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc_tables(
    spark: SparkSession,
    url: str,
    tables: Sequence[str],
    props: Mapping[str, str],
    partitioning: Mapping[str, tuple[str, int, int, int]] | None = None,
) -> dict[str, DataFrame]:
    """Full scans of database tables; ``partitioning`` maps a table to its key range."""
    split = partitioning or {}
    return {
        name: spark.read.format("jdbc").options(**jdbc_options(url, name, *split.get(name, ())), **props).load()
        for name in tables
    }


def read_sources(
    spark: SparkSession, root: str, names: Sequence[str] = tuple(SOURCES), catalogued: bool = False
) -> dict[str, DataFrame]:
    """Source tables by their logical name, from a folder or from the database ``root``."""
    if catalogued:
        return {name: spark.table(f"`{root}`.`{SOURCES[name]}`") for name in names}
    return {name: spark.read.parquet(f"{root}/{SOURCES[name]}") for name in names}


def write_table(
    df: DataFrame,
    path: str,
    schema: str | T.StructType,
    disposition: str = "WRITE_TRUNCATE",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    stamp: str | None = None,
    curve_by: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """Write ``df`` in exactly the given columns and types, replacing or appending.

    ``partition_by`` makes one folder per value. Rows are brought together by it (or else by
    ``cluster_by``) in files of even size: a large value is split, small ones share a file.
    Within a file they are sorted by ``cluster_by``. With ``curve_by`` instead, files follow a
    space-filling curve through those columns, and a filter on any of them skips files;
    ``files`` is their number. ``stamp`` names a load-time column to add.
    """
    modes = {"WRITE_TRUNCATE": "overwrite", "WRITE_APPEND": "append"}
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])
    if stamp:
        out = out.withColumn(stamp, F.current_timestamp())
    if curve_by:
        if partition_by or cluster_by:
            raise ValueError("curve_by stands alone")
        out = along_curve(out, curve_by, files)
    elif partition_by or cluster_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by or cluster_by])
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    out.write.mode(modes[disposition]).partitionBy(*partition_by).parquet(path)


def materialize(
    df: DataFrame,
    name: str,
    kind: str,
    path: str | None = None,
    bucket_by: tuple[int, str] | None = None,
) -> DataFrame:
    """Register ``df`` as a view, or write it as a table, under ``name``.

    A catalogue table can be bucketed, as (number of buckets, key): tables in the same
    buckets are joined and grouped on that key without a shuffle.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif path is not None:
        df.write.mode("overwrite").parquet(path)
        spark.read.schema(df.schema).parquet(path).createOrReplaceTempView(name)
    elif bucket_by is not None:
        # One task per bucket writes it, so that a bucket is one file and not one per task.
        buckets, key = bucket_by
        rows = df.repartition(buckets, key)
        rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    else:
        df.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def list_tables(spark: SparkSession, db: str, like: str | None = None) -> DataFrame:
    """Names of the tables of a database, optionally those LIKE a pattern."""
    names = spark.sql(f"SHOW TABLES IN `{db}`").select(F.col("tableName").alias("table_name"))
    return names if like is None else names.where(F.col("table_name").like(like))


def cached(df: DataFrame) -> DataFrame:
    """Keep a loaded mart for further reports; a written table, so that it survives an executor."""
    return keep(df, "mart")


def with_load_time(df: DataFrame, name: str = "loaded_at", at: Column | None = None) -> DataFrame:
    return df.withColumn(name, F.current_timestamp() if at is None else at)
