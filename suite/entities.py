"""The given tables in the shape of the library's entities, for Spark and for DuckDB.

Both sides state the same mapping, each in its own language; money on the DuckDB side is
whole units (cents, hundredths of a cent), so that it can be rounded without error.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.lookups import lookup_frame
from tradewind.operators import staging
from tradewind.session import configure

CATEGORY_NAMES = [("ECONOMY", "budget"), ("SMALL", "compact"), ("LARGE", "bulky"), ("PROMO", "on_offer")]
FIRST_DAY, DAYS = "1995-01-01", 2557
BAD_ORDERS = (11, 12)

# The kinds of events, each a series of its own.
EVENT_SERIES = ("click", "error", "purchase", "signup", "view")

# Stated, so that no file has to be opened to plan a query.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
                 o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
                   l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING,
                   l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,
                 props STRING""",
}


def moved(key, where):
    """The key, or its negative ``where`` the row is to be an orphan: it stays in its table."""
    return F.when(where, -key).otherwise(key)


class Entities:
    """Entities over the tables in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def raw_orders(self) -> DataFrame:
        key, bought = F.col("o_orderkey"), F.col("o_orderdate")

        def later(days, missing):
            return F.when(key % missing != 0, bought + F.make_dt_interval(days.cast("int")))

        return self.table("orders").select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "F", "delivered")
            .when(F.col("o_orderstatus") == "O", "shipped")
            .otherwise("canceled")
            .alias("order_status"),
            bought.alias("order_purchase_timestamp"),
            later(F.lit(1), 5).alias("order_approved_at"),
            later(F.lit(3), 11).alias("order_delivered_carrier_date"),
            later(key % 20 + 1, 7).alias("order_delivered_customer_date"),
            (bought + F.make_dt_interval(F.lit(15))).alias("order_estimated_delivery_date"),
        )

    @cached_property
    def raw_items(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").cast("bigint").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_extendedprice") * F.col("l_tax") + F.lit(0.0)).alias("freight_value"),
        )

    @cached_property
    def raw_customers(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return self.table("customer").join(nation, "c_nationkey").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            (F.col("c_nationkey") * 100 + F.col("c_custkey") % 100).cast("string").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )

    @cached_property
    def raw_products(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        return self.table("part").select(
            moved(key, key % 97 == 0).alias("product_id"),
            F.when(key % 50 != 0, F.col("p_type")).alias("product_category_name"),
            F.length("p_name").cast("bigint").alias("product_name_lenght"),
            (F.length("p_name") * 10).cast("bigint").alias("product_description_lenght"),
            (size % 4).cast("bigint").alias("product_photos_qty"),
            F.when(key % 17 != 0, size * 100).cast("double").alias("product_weight_g"),
            F.when(key % 19 != 0, size + 1).cast("double").alias("product_length_cm"),
            F.when(key % 23 != 0, size + 2).cast("double").alias("product_height_cm"),
            F.when(key % 29 != 0, size * 2).cast("double").alias("product_width_cm"),
        )

    @cached_property
    def raw_payments(self) -> DataFrame:
        key = F.col("o_orderkey")
        kinds = F.array(*[F.lit(k) for k in ("credit_card", "boleto", "voucher", "debit_card")])
        plans = F.array(
            F.struct(F.lit(1).cast("bigint").alias("payment_sequential"), F.col("o_totalprice").alias("payment_value")),
            F.struct(F.lit(2).cast("bigint").alias("payment_sequential"), F.lit(10.5).alias("payment_value")),
        )
        return self.table("orders").select(
            moved(key, key % 13 == 0).alias("order_id"), F.inline(plans),
            F.when(key % 50 != 0, F.get(kinds, (key % 4).cast("int"))).alias("payment_type"),
            (key % 24 + 1).alias("payment_installments"),
        ).where((F.col("payment_sequential") == 1) | (F.col("order_id") % 4 == 0))

    @cached_property
    def raw_reviews(self) -> DataFrame:
        key = F.col("o_orderkey")
        number = F.when(key % 9 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return self.table("orders").select(key, "o_orderdate", F.explode(number).alias("number")).select(
            F.concat(key.cast("string"), F.lit("-"), F.col("number").cast("string")).alias("review_id"),
            moved(key, key % 7 == 0).alias("order_id"),
            F.when(key % 10 != 0, key % 5 + F.col("number") % 2).alias("review_score"),
            F.lit("title").alias("review_comment_title"),
            (F.col("o_orderdate") + F.make_dt_interval(F.lit(20))).alias("review_creation_date"),
            (F.col("o_orderdate") + F.make_dt_interval(F.lit(22))).alias("review_answer_timestamp"),
        )

    @cached_property
    def raw_sellers(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("seller_id"),
            (F.col("s_suppkey") % 100).cast("string").alias("seller_zip_code_prefix"),
            F.concat(F.lit("City "), F.col("s_nationkey").cast("string")).alias("seller_city"),
            F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("seller_state"),
        )

    @cached_property
    def raw_geo(self) -> DataFrame:
        """Positions by zip prefix: some repeat, some customers' prefixes and one whole state have none."""
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        elsewhere = F.when((nation == 24) | (key % 100 % 7 == 0), 100_000).otherwise(0)
        return self.table("customer").select(
            (nation * 100 + key % 100 + elsewhere).cast("string").alias("geolocation_zip_code_prefix"),
            (key % 300 / F.lit(8.0) - F.lit(30.0)).alias("geolocation_lat"),
            (nation / F.lit(4.0) - F.lit(60.0)).alias("geolocation_lng"),
            F.concat(F.lit("Place "), (key % 3).cast("string")).alias("geolocation_city"),
            F.lit("BR").alias("geolocation_state"),
        )

    @cached_property
    def lookup(self) -> DataFrame:
        return lookup_frame(self.spark, CATEGORY_NAMES)

    @cached_property
    def raw_indicators(self) -> DataFrame:
        """A rate per weekday, inflation and interest per month, as one long table."""
        day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("id").cast("int"))
        days = self.spark.range(DAYS).withColumn("data", day)
        first = F.dayofmonth("data") == 1
        fx = (F.col("id") * 37 % 250 + 250) / F.lit(100.0)
        ipca = F.col("id") % 90 / F.lit(100.0)
        selic = (F.col("id") % 100 + 50) / F.lit(10.0)

        def cell(name, number, value):
            return F.struct(
                F.lit(name).alias("series_name"),
                F.lit(number).cast("bigint").alias("series_id"),
                value.alias("valor"),
            )

        values = F.array(
            cell("exchange_rate_usd", 1, F.when(F.weekday("data") < 5, fx)),
            cell("ipca", 433, F.when(first, ipca)),
            cell("selic", 4189, F.when(first, selic)),
        )
        return days.select("data", F.inline(values)).withColumn(
            "extracted_at", F.lit("2002-01-01 06:00:00").cast("timestamp")
        )

    @cached_property
    def series(self) -> DataFrame:
        """The events as raw observations: five series with a date, a value and a load time."""
        return self.table("events").select(
            F.to_date("ts").alias("data"),
            F.col("value").alias("valor"),
            F.col("event_type").alias("series_name"),
            F.length("event_type").cast("bigint").alias("series_id"),
            F.col("ts").alias("extracted_at"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stg_orders(self.raw_orders)

    @cached_property
    def items(self) -> DataFrame:
        return staging.stg_order_items(self.raw_items)

    @cached_property
    def customers(self) -> DataFrame:
        return staging.stg_customers(self.raw_customers)

    @cached_property
    def products(self) -> DataFrame:
        return staging.stg_products(self.raw_products)

    @cached_property
    def ind(self) -> DataFrame:
        return staging.stg_indicators(self.raw_indicators)


_LOOKUP = ", ".join(f"('{pt}', '{en}')" for pt, en in CATEGORY_NAMES)

# Each entity as SQL; `c` is cents, `u` hundredths of a cent.
CTES = {
    "e_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END
                 AS order_status,
               o_orderdate AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + INTERVAL 1 DAY END AS order_approved_at,
               CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + INTERVAL 3 DAY END
                 AS order_delivered_carrier_date,
               CASE WHEN o_orderkey % 7 <> 0
                    THEN o_orderdate + to_days(CAST(o_orderkey % 20 + 1 AS INTEGER)) END
                 AS order_delivered_customer_date,
               o_orderdate + INTERVAL 15 DAY AS order_estimated_delivery_date,
               CAST(o_orderdate AS DATE) AS order_date,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month
        FROM orders""",
    "e_items": """
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
               l_partkey AS product_id, l_suppkey AS seller_id,
               l_shipdate AS shipping_limit_date, l_extendedprice AS price,
               l_extendedprice * l_tax + 0.0 AS freight_value,
               CAST(round(l_extendedprice * 100) AS HUGEINT) AS price_c,
               CAST(round(l_extendedprice * 100) * round(l_tax * 100) AS HUGEINT) AS freight_u,
               CAST(round(l_extendedprice * 100) * (100 + round(l_tax * 100)) AS HUGEINT) AS total_u
        FROM lineitem""",
    "e_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
               CAST(c_nationkey * 100 + c_custkey % 100 AS VARCHAR) AS customer_zip_code_prefix,
               c_mktsegment AS customer_city, n_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "e_products": """
        SELECT CASE WHEN p_partkey % 97 = 0 THEN -p_partkey ELSE p_partkey END AS product_id,
               CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS product_category_name,
               CAST(length(p_name) AS BIGINT) AS product_name_lenght,
               CAST(length(p_name) * 10 AS BIGINT) AS product_description_lenght,
               CAST(p_size % 4 AS BIGINT) AS product_photos_qty,
               CAST(CASE WHEN p_partkey % 17 <> 0 THEN p_size * 100 END AS DOUBLE) AS product_weight_g,
               CAST(CASE WHEN p_partkey % 19 <> 0 THEN p_size + 1 END AS DOUBLE) AS product_length_cm,
               CAST(CASE WHEN p_partkey % 23 <> 0 THEN p_size + 2 END AS DOUBLE) AS product_height_cm,
               CAST(CASE WHEN p_partkey % 29 <> 0 THEN p_size * 2 END AS DOUBLE) AS product_width_cm
        FROM part""",
    "e_payments": """
        SELECT CASE WHEN o_orderkey % 13 = 0 THEN -o_orderkey ELSE o_orderkey END AS order_id,
               s AS payment_sequential,
               CASE WHEN o_orderkey % 50 <> 0 THEN
                 CASE o_orderkey % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto'
                                     WHEN 2 THEN 'voucher' ELSE 'debit_card' END END AS payment_type,
               o_orderkey % 24 + 1 AS payment_installments,
               CASE s WHEN 1 THEN o_totalprice ELSE 10.5 END AS payment_value
        FROM orders, (VALUES (CAST(1 AS BIGINT)), (CAST(2 AS BIGINT))) n(s)
        WHERE s = 1 OR o_orderkey % 4 = 0""",
    "e_reviews": """
        SELECT o_orderkey || '-' || n AS review_id,
               CASE WHEN o_orderkey % 7 = 0 THEN -o_orderkey ELSE o_orderkey END AS order_id,
               CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 5 + n % 2 END AS review_score,
               'title' AS review_comment_title,
               o_orderdate + INTERVAL 20 DAY AS review_creation_date,
               o_orderdate + INTERVAL 22 DAY AS review_answer_timestamp
        FROM orders, (VALUES (1), (2)) v(n)
        WHERE n = 1 OR o_orderkey % 9 = 0""",
    "e_sellers": """
        SELECT s_suppkey AS seller_id, CAST(s_suppkey % 100 AS VARCHAR) AS seller_zip_code_prefix,
               'City ' || s_nationkey AS seller_city, 'S' || s_nationkey AS seller_state
        FROM supplier""",
    "e_geo": """
        SELECT CAST(c_nationkey * 100 + c_custkey % 100
                    + CASE WHEN c_nationkey = 24 OR c_custkey % 100 % 7 = 0 THEN 100000 ELSE 0 END AS VARCHAR)
                 AS geolocation_zip_code_prefix,
               CAST(c_custkey % 300 AS DOUBLE) / 8 - 30 AS geolocation_lat,
               CAST(c_nationkey AS DOUBLE) / 4 - 60 AS geolocation_lng,
               'Place ' || (c_custkey % 3) AS geolocation_city, 'BR' AS geolocation_state
        FROM customer""",
    "e_lookup": f"SELECT * FROM (VALUES {_LOOKUP}) v(product_category_name, product_category_name_english)",
    "e_days": f"SELECT k, DATE '{FIRST_DAY}' + CAST(k AS INTEGER) AS d FROM range(0, {DAYS}) r(k)",
    # rate in hundredths, inflation in hundredths, interest in tenths
    "e_fx": "SELECT d, CAST(k * 37 % 250 + 250 AS HUGEINT) AS r FROM e_days WHERE isodow(d) < 6",
    "e_ipca": "SELECT d AS m, CAST(k % 90 AS HUGEINT) AS v FROM e_days WHERE day(d) = 1",
    "e_selic": "SELECT d AS m, CAST(k % 100 + 50 AS HUGEINT) AS v FROM e_days WHERE day(d) = 1",
    "e_series": """
        SELECT CAST(ts AS DATE) AS data, value AS valor, event_type AS series_name,
               CAST(length(event_type) AS BIGINT) AS series_id, ts AS extracted_at
        FROM events""",
}
