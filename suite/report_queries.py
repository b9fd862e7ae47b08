"""Filters, reports, profiles, cleaning, checks, readers and writers, the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.entities import BAD_ORDERS, EVENT_SERIES, Entities
from suite.marts_queries import (
    COPIES, D3, D4, D5, D7, D8, FRAME, LISTS, MARTS, STAR, d2, d3, d4, d7, d8, frame, plain_times, t6, t7, t9, t11, t12,
)
from suite.registry import query
from tradewind.functions import scalars as S
from tradewind.functions.lookups import display_category
from tradewind.operators import clean, medians, profile, quality, staging
from tradewind.plans import build, checks, reports, star
from tradewind.session import keep, scratch_path
from tradewind.sources import indicators as series
from tradewind.sources import tables
from tradewind.streaming import intake

# ---- filters -------------------------------------------------------------------------

MONTHS = ("1996-03-15", "1998-06-30")
CATEGORIES = ("budget", "compact", "MEDIUM")
PERIODS = ("Strong BRL", "Weak BRL")
IN_MONTHS = f"order_month BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}'"


def loaded(e: Entities, lang: str = "English") -> DataFrame:
    return display_category(reports.load_category(d3(e)), lang)


def loaded_geo(e: Entities) -> DataFrame:
    return display_category(reports.load_geo(d4(e)))


CAT = {"cat": "SELECT *, category_name AS display_category FROM m_cat WHERE category_name IS NOT NULL"} | MARTS
GEO = {"geo": "SELECT *, category_name AS display_category FROM m_geo WHERE category_name IS NOT NULL"} | MARTS
CAT_COLUMNS = """category_name, category_name_pt, order_month, customer_state, order_count,
    total_revenue_brl, total_revenue_usd, avg_order_value_brl, avg_exchange_rate, exchange_rate_period"""
GEO_COLUMNS = """customer_state, customer_city, order_month, category_name, category_name_pt,
    order_count, total_revenue_brl, total_revenue_usd, avg_exchange_rate, currency_strength"""

query("s11_load_category", f"SELECT {CAT_COLUMNS} FROM cat", CAT)(lambda e: reports.load_category(d3(e)))
query("s11_load_geo", f"SELECT {GEO_COLUMNS} FROM geo", GEO)(lambda e: reports.load_geo(d4(e)))
WIDE_MARTS = {"m_wide": D5, "wide": "SELECT *, product_category_name AS display_category FROM m_wide"}
query("s11_load_wide", "SELECT * FROM m_wide", WIDE_MARTS)(lambda e: reports.load_wide(d3(e, wide=True)))
query(
    "a10_kpis_wide",
    """SELECT CAST(coalesce(sum(order_count), 0) AS BIGINT) AS total_orders,
              CAST(coalesce(sum(CAST(total_revenue_usd AS DECIMAL(18, 4))), 0) AS DOUBLE) AS total_revenue_usd,
              CAST(sum(CAST(avg_exchange_rate AS DECIMAL(18, 6))) AS DOUBLE) / nullif(count(avg_exchange_rate), 0)
                AS avg_exchange_rate,
              count(DISTINCT product_category_name) AS categories_count
       FROM wide WHERE product_category_name IN ('SMALL', 'LARGE')""",
    WIDE_MARTS,
)(lambda e: reports.kpis(reports.apply_filters(d3(e, wide=True), categories=("SMALL", "LARGE"))))
query(
    "a12_cat_period_wide",
    """SELECT display_category, exchange_rate_period, CAST(sum(order_count) AS BIGINT) AS order_count,
              CAST(coalesce(sum(CAST(total_revenue_usd AS DECIMAL(18, 4))), 0) AS DOUBLE) AS total_revenue_usd
       FROM wide GROUP BY ALL""",
    WIDE_MARTS,
)(lambda e: reports.category_by_period(display_category(d3(e, wide=True))))
query("f4_date_range", f"SELECT {CAT_COLUMNS} FROM cat WHERE {IN_MONTHS}", CAT)(
    lambda e: reports.apply_filters(reports.load_category(d3(e)), months=MONTHS)
)
query(
    "f5_multi_select",
    f"SELECT {CAT_COLUMNS} FROM cat WHERE category_name IN {CATEGORIES} AND exchange_rate_period IN {PERIODS}",
    CAT,
)(lambda e: reports.apply_filters(reports.load_category(d3(e)), categories=CATEGORIES, periods=PERIODS))
query(
    "f6_default_selection",
    f"""SELECT {GEO_COLUMNS} FROM geo
        WHERE customer_state IN (SELECT DISTINCT customer_state FROM geo ORDER BY 1 LIMIT 5)
          AND category_name IN (SELECT DISTINCT category_name FROM cat ORDER BY 1 LIMIT 5)""",
    CAT | GEO,
)(
    lambda e: reports.apply_filters(
        geo := reports.load_geo(d4(e)),
        categories=reports.default_selection(reports.load_category(d3(e)), "category_name"),
        states=reports.default_selection(geo, "customer_state"),
    )
)
query(
    "f8_null_mask",
    """SELECT order_status, count(*) AS row_count FROM e_orders WHERE order_approved_at IS NULL
       AND order_status = 'canceled' GROUP BY 1""",
)(
    lambda e: e.orders.where(clean.null_mask("order_approved_at", "canceled"))
    .groupBy("order_status").agg(F.count("*").alias("row_count"))
)
query(
    "f9_semi",
    """SELECT order_id, payment_type, payment_value FROM e_payments WHERE order_id IN
       (SELECT order_id FROM e_orders WHERE order_approved_at IS NULL AND order_status = 'delivered')""",
)(
    lambda e: clean.only_in(
        e.raw_payments.select("order_id", "payment_type", "payment_value"),
        e.orders.where(clean.null_mask("order_approved_at", "delivered")), "order_id",
    )
)
query(
    "f10_delivered",
    "SELECT order_id, order_date FROM e_orders WHERE order_status = 'delivered'",
)(
    lambda e: e.orders.where(F.col("order_status") == "delivered").select(
        "order_id", F.to_date("order_purchase_timestamp").alias("order_date")
    )
)

# ---- reports -------------------------------------------------------------------------

ORDERS = "CAST(coalesce(sum(order_count), 0) AS BIGINT) AS {}"
N = ORDERS.format("order_count")
USD = "CAST(coalesce(sum(CAST(total_revenue_usd AS DECIMAL(18, 4))), 0) AS DOUBLE) AS total_revenue_usd"
MEAN_RATE = """CAST(sum(CAST(avg_exchange_rate AS DECIMAL(18, 6))) AS DOUBLE)
               / nullif(count(avg_exchange_rate), 0) AS avg_exchange_rate"""

query(
    "a10_kpis",
    f"""SELECT {ORDERS.format("total_orders")}, {USD}, {MEAN_RATE},
               count(DISTINCT category_name) AS categories_count
        FROM cat WHERE category_name IN {CATEGORIES}""",
    CAT,
)(lambda e: reports.kpis(reports.apply_filters(loaded(e), categories=CATEGORIES)))
query("a11_monthly", f"SELECT order_month, {USD}, {N}, {MEAN_RATE} FROM cat GROUP BY 1", CAT)(
    lambda e: reports.monthly(loaded(e))
)
query(
    "a12_cat_period",
    f"SELECT display_category, exchange_rate_period, {N}, {USD} FROM cat GROUP BY ALL",
    CAT,
)(lambda e: reports.category_by_period(loaded(e)))
query(
    "a13_top_categories",
    f"""SELECT display_category, {N}, {USD}, {MEAN_RATE} FROM cat GROUP BY 1
        ORDER BY total_revenue_usd DESC, 1 LIMIT 4""",
    CAT,
)(lambda e: reports.top_categories(loaded(e), 4))
query(
    "a14_category_trend",
    f"SELECT order_month, {N}, {USD} FROM cat WHERE display_category = 'budget' GROUP BY 1",
    CAT,
)(lambda e: reports.category_trend(loaded(e), "budget"))
query("a15_states", f"SELECT customer_state, {N}, {USD} FROM geo GROUP BY 1", GEO)(
    lambda e: reports.state_sales(loaded_geo(e))
)
query(
    "o2_top_states",
    f"SELECT customer_state, {N}, {USD} FROM geo GROUP BY 1 ORDER BY total_revenue_usd DESC, 1 LIMIT 10",
    GEO,
)(lambda e: reports.state_sales(loaded_geo(e), 10))
query("a16_state_category", f"SELECT customer_state, display_category, {N} FROM geo GROUP BY ALL", GEO)(
    lambda e: reports.state_category(loaded_geo(e))
)
SHOWN = ("budget", "compact", "bulky", "on_offer", "MEDIUM", "STANDARD")
query(
    "a19_state_category_pivot",
    "SELECT customer_state, "
    + ", ".join(
        f"CAST(coalesce(sum(order_count) FILTER (display_category = '{c}'), 0) AS BIGINT) AS {c}" for c in SHOWN
    )
    + " FROM geo GROUP BY 1",
    GEO,
)(
    lambda e: reports.pivot_counts(
        reports.state_category(loaded_geo(e)), "customer_state", "display_category", "order_count", SHOWN
    )
)
query(
    "a17_top_cities",
    f"""SELECT customer_state, customer_city, {N}, {USD}, customer_city || ', ' || customer_state AS city_state
        FROM geo GROUP BY ALL ORDER BY total_revenue_usd DESC, 1, 2 LIMIT 15""",
    GEO,
)(lambda e: reports.top_cities(loaded_geo(e)))
query(
    "a18_period_summary",
    f"SELECT exchange_rate_period, {N}, {USD}, {MEAN_RATE} FROM cat GROUP BY 1",
    CAT,
)(lambda e: reports.period_summary(loaded(e)))
query(
    "x16_language_both",
    f"""SELECT category_name || ' (' || category_name_pt || ')' AS display_category, {N} FROM cat GROUP BY 1""",
    CAT,
)(
    lambda e: loaded(e, "Both").groupBy("display_category").agg(F.sum("order_count").alias("order_count"))
)
query(
    "x16_language_portuguese",
    f"SELECT category_name_pt AS display_category, {N} FROM cat GROUP BY 1",
    CAT,
)(
    lambda e: loaded(e, "Portuguese").groupBy("display_category").agg(F.sum("order_count").alias("order_count"))
)
query(
    "x22_elasticity",
    """SELECT display_category, coalesce(CAST(100 * (w - s) AS DOUBLE) / nullif(s, 0), 0) AS elasticity
       FROM (SELECT display_category,
                    coalesce(sum(order_count) FILTER (exchange_rate_period = 'Strong BRL'), 0) AS s,
                    coalesce(sum(order_count) FILTER (exchange_rate_period = 'Weak BRL'), 0) AS w
             FROM cat GROUP BY 1)
       ORDER BY elasticity DESC, 1 LIMIT 15""",
    CAT,
)(lambda e: reports.elasticity(loaded(e)))
query("a28_month_bounds", "SELECT min(order_month) AS min_month, max(order_month) AS max_month FROM cat", CAT)(
    lambda e: profile.month_bounds(loaded(e))
)
query(
    "o4_months_descending", "SELECT order_month, count(*) AS row_count FROM cat GROUP BY 1", CAT
)(
    lambda e: loaded(e).groupBy("order_month").agg(F.count("*").alias("row_count")).orderBy(F.desc("order_month"))
)
query("o6_sorted_values", "SELECT DISTINCT customer_state FROM e_customers ORDER BY 1")(
    lambda e: clean.distinct_values(e.customers, "customer_state")
)
query(
    "s12_load_customer",
    """SELECT * FROM m_items ORDER BY order_id, product_id, price, freight_value LIMIT 5000""",
    MARTS,
)(
    lambda e: reports.load_customer(
        d2(e), 5000, order_by=("order_id", "product_id", "price", "freight_value")
    )
)
query("s14_peek", "SELECT order_id, order_status FROM e_orders ORDER BY order_id LIMIT 3")(
    lambda e: profile.peek(e.orders.select("order_id", "order_status"), 3, "order_id")
)
query("s15_sample")(lambda e: profile.sample_rows(e.orders.select("order_id", "order_status"), 3, seed=7))
query("s13_cached_mart", f"SELECT {CAT_COLUMNS} FROM cat", CAT)(
    lambda e: tables.cached(reports.load_category(d3(e)))
)

# ---- profiles ------------------------------------------------------------------------

query(
    "a8_stats",
    """SELECT count(*) AS total_records, count(DISTINCT series_name) AS series_count,
              min(data) AS earliest_date, max(data) AS latest_date, max(extracted_at) AS extraction_time
       FROM e_series""",
)(lambda e: profile.table_stats(e.series, "series_name", "data", "extracted_at"))
NAMES = ("orders", "lineitem", "customer", "part", "supplier")
query(
    "a9_row_counts",
    f"""WITH c AS ({" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in NAMES)})
        SELECT * FROM c UNION ALL SELECT 'total', CAST(sum(row_count) AS BIGINT) FROM c""",
)(lambda e: profile.row_counts({n: e.table(n) for n in NAMES}))
query(
    "f14_like_prefix",
    """SELECT 'part' AS table_name, count(*) AS row_count FROM part""",
)(
    lambda e: profile.row_counts({n: e.table(n) for n in NAMES}, total=False)
    .where(F.col("table_name").like("p_r%"))
)
FRAME_DELIVERED = "f_all WHERE order_status = 'delivered'"


def delivered(e: Entities) -> DataFrame:
    """Rows as in the analysis frame, with the columns the category statistics need."""
    orders = clean.fill_orders(e.raw_orders, BAD_ORDERS).where(F.col("order_status") == "delivered")
    english = staging.strict_products(e.raw_products, e.lookup).select(
        "product_id", F.col("product_category_name_english").alias("product_category_english")
    )
    rows = orders.select("order_id")
    for side in (
        e.raw_items.select("order_id", "product_id"),
        e.raw_payments.select("order_id", "payment_value"),
        e.raw_reviews.select("order_id", "review_score"),
    ):
        rows = rows.join(side, "order_id", "left")
    return rows.join(english, "product_id", "left").fillna({"product_category_english": "unmapped"})


query(
    "a20_value_counts",
    f"SELECT product_category_english, count(*) AS row_count FROM {FRAME_DELIVERED} GROUP BY 1",
    FRAME,
)(lambda e: profile.value_counts(delivered(e), "product_category_english"))
query(
    "o3_top_counts",
    f"""SELECT product_category_english, count(*) AS row_count FROM {FRAME_DELIVERED} GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 3""",
    FRAME,
)(
    lambda e: profile.top_bottom(
        profile.value_counts(delivered(e), "product_category_english"), "row_count", 3
    )
)
query(
    "o3_bottom_counts",
    f"""SELECT product_category_english, count(*) AS row_count FROM {FRAME_DELIVERED} GROUP BY 1
        ORDER BY 2, 1 LIMIT 3""",
    FRAME,
)(
    lambda e: profile.top_bottom(
        profile.value_counts(delivered(e), "product_category_english"), "row_count", 3, largest=False
    )
)
query(
    "a21_ratings",
    f"""SELECT product_category_english, round_even(avg(review_score), 3) AS avg_rating
        FROM {FRAME_DELIVERED} GROUP BY 1""",
    FRAME,
)(lambda e: profile.mean_rating(delivered(e)))
query(
    "a22_median_payment",
    f"""SELECT product_category_english, CAST(round_even(median(payment_value), 0) AS BIGINT) AS median_payment
        FROM {FRAME_DELIVERED} GROUP BY 1""",
    FRAME,
)(lambda e: profile.median_payment(delivered(e)))
query(
    "a22_median_per_status",
    "SELECT order_status, median(CAST(price AS DOUBLE)) AS price FROM e_items JOIN e_orders USING (order_id) GROUP BY 1",
)(lambda e: medians.medians(e.items.join(e.orders, "order_id"), ["order_status"], ["price"]))
SIZES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
query(
    "a23_column_medians",
    f"SELECT {', '.join(f'median({c}) AS {c}' for c in SIZES)} FROM e_products",
)(lambda e: medians.column_medians(e.raw_products, SIZES))
ORDER_COLUMNS = (
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
)
query(
    "a25_nulls",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM e_orders" for c in ORDER_COLUMNS
    ),
)(lambda e: profile.null_counts(e.orders))
query(
    "a26_duplicates",
    """SELECT false AS duplicated, count(*) AS row_count FROM (SELECT DISTINCT * FROM e_geo)
       UNION ALL SELECT true, (SELECT count(*) FROM e_geo) - (SELECT count(*) FROM (SELECT DISTINCT * FROM e_geo))""",
)(lambda e: profile.duplicate_rows(e.raw_geo))
query(
    "a27_profile",
    """SELECT column_name, data_type, (SELECT count(*) FROM e_items) AS row_count,
              CAST(4 AS BIGINT) AS column_count
       FROM (VALUES ('order_id', 'bigint'), ('order_item_id', 'bigint'), ('price', 'double'),
                    ('freight_value', 'double')) v(column_name, data_type)""",
)(lambda e: profile.profile(e.items.select("order_id", "order_item_id", "price", "freight_value")))
query(
    "a29_series_summary",
    """SELECT series_name, count(*) AS records, min(data) AS first_date, max(data) AS last_date
       FROM e_series GROUP BY 1""",
)(lambda e: profile.series_summary(e.series))

# ---- cleaning ------------------------------------------------------------------------

query(
    "u2_distinct",
    "SELECT DISTINCT * FROM e_geo",
)(lambda e: clean.dedupe(e.raw_geo))
query(
    "i2_median_fill",
    f"""SELECT product_id, coalesce(product_category_name, 'unknown') AS product_category_name,
        {', '.join(f"coalesce({c}, (SELECT median({c}) FROM e_products)) AS {c}" for c in SIZES)}
        FROM e_products""",
)(lambda e: clean.fill_products(e.raw_products))
query(
    "i3_approve_delivered",
    """SELECT order_id, CASE WHEN order_approved_at IS NULL AND order_status = 'delivered'
              THEN order_purchase_timestamp ELSE order_approved_at END AS order_approved_at FROM e_orders""",
)(lambda e: plain_times(clean.approve_delivered(e.orders).select("order_id", "order_approved_at")))
query(
    "i4_i5_fill_orders",
    f"""SELECT order_id, customer_id, order_status, order_purchase_timestamp,
               coalesce(order_approved_at, order_purchase_timestamp) AS order_approved_at,
               order_delivered_carrier_date,
               coalesce(order_delivered_customer_date, order_estimated_delivery_date)
                 AS order_delivered_customer_date, order_estimated_delivery_date
        FROM e_orders WHERE order_id NOT IN {BAD_ORDERS}""",
)(lambda e: plain_times(clean.fill_orders(e.orders, BAD_ORDERS)))
query(
    "i6_payment_type",
    """SELECT coalesce(payment_type, 'not_defined') AS payment_type, count(*) AS row_count
       FROM e_payments GROUP BY 1""",
)(
    lambda e: clean.fill_payment_type(e.raw_payments).groupBy("payment_type").agg(F.count("*").alias("row_count"))
)
PLACES = {
    "g_geo": """SELECT geolocation_zip_code_prefix, avg(geolocation_lat) AS lat, avg(geolocation_lng) AS lng
                FROM (SELECT DISTINCT * FROM e_geo) GROUP BY ALL""",
    "g_rows": """SELECT customer_id, customer_state, lat, lng
                 FROM e_customers LEFT JOIN g_geo ON customer_zip_code_prefix = geolocation_zip_code_prefix""",
    "g_state": "SELECT customer_state, median(lat) AS mlat, median(lng) AS mlng FROM g_rows GROUP BY 1",
    "g_filled": """SELECT customer_id, customer_state, coalesce(lat, mlat) AS lat, coalesce(lng, mlng) AS lng
                   FROM g_rows JOIN g_state USING (customer_state)""",
}


def places(e: Entities) -> DataFrame:
    spots = staging.zip_centroids(e.raw_geo).withColumnRenamed(
        "geolocation_zip_code_prefix", "customer_zip_code_prefix"
    )
    return e.customers.join(spots, "customer_zip_code_prefix", "left").select(
        "customer_id", "customer_state", "geolocation_lat", "geolocation_lng"
    )


query(
    "w1_group_median_fill",
    """SELECT customer_id, customer_state, lat AS geolocation_lat, lng AS geolocation_lng FROM g_filled""",
    PLACES,
)(lambda e: medians.fill_with_group_median(places(e), "customer_state", ["geolocation_lat", "geolocation_lng"]))
query(
    "i7_geo_fill",
    """SELECT customer_id, customer_state,
              coalesce(lat, (SELECT median(lat) FROM g_filled)) AS geolocation_lat,
              coalesce(lng, (SELECT median(lng) FROM g_filled)) AS geolocation_lng
       FROM g_filled""",
    PLACES,
)(lambda e: clean.fill_geo(places(e), "customer_state"))

# ---- scalars -------------------------------------------------------------------------

query(
    "x1_safe_cast",
    """SELECT p_partkey, TRY_CAST(t AS BIGINT) AS whole, TRY_CAST(t AS DOUBLE) AS number,
              TRY_CAST(t AS DATE) AS day, CAST(trunc(p_size / 2.0 + 0.5) AS BIGINT) AS rounded
       FROM (SELECT p_partkey, p_size, CASE p_partkey % 4 WHEN 0 THEN 'bad' WHEN 1 THEN ''
                    WHEN 2 THEN CAST(p_size AS VARCHAR) ELSE '2017-05-17' END AS t FROM part)""",
)(
    lambda e: e.table("part").select(
        "p_partkey", "p_size",
        F.get(F.array(F.lit("bad"), F.lit(""), F.col("p_size").cast("string"), F.lit("2017-05-17")),
              (F.col("p_partkey") % 4).cast("int")).alias("t"),
    ).select(
        "p_partkey",
        S.safe_cast(F.col("t"), "bigint").alias("whole"),
        S.safe_cast(F.col("t"), "double").alias("number"),
        F.when(F.length("t") == 10, S.safe_cast(F.col("t"), "date")).alias("day"),
        S.safe_cast(F.col("p_size") / 2, "bigint", from_float=True).alias("rounded"),
    )
)
query(
    "x7_trim",
    "SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low FROM part",
)(
    lambda e: e.table("part").select(
        "p_partkey",
        S.clean_trim(F.upper(F.concat(F.lit("\t "), "p_name", F.lit(" \n")))).alias("up"),
        S.clean_trim(F.lower("p_type")).alias("low"),
    )
)
query(
    "x8_x9_buckets",
    """SELECT p_partkey,
         CASE WHEN p_size / 10.0 < 3.5 THEN 'Strong BRL (< 3.5)'
              WHEN p_size / 10.0 BETWEEN 3.5 AND 4.5 THEN 'Moderate BRL (3.5-4.5)'
              ELSE 'Weak BRL (> 4.5)' END AS fx,
         CASE WHEN p_partkey % 9 <> 0 AND p_size < 7 THEN 'Low Interest (< 7%)'
              WHEN p_partkey % 9 <> 0 AND p_size BETWEEN 7 AND 12 THEN 'Moderate Interest (7-12%)'
              ELSE 'High Interest (> 12%)' END AS interest,
         CASE WHEN p_size / 10.0 < 3.5 THEN 'Strong BRL' ELSE 'Weak BRL' END AS strength
       FROM part""",
)(
    lambda e: e.table("part").select(
        "p_partkey",
        S.bucket(F.col("p_size") / 10.0, *S.FX_LIMITS, S.ROW_FX_LABELS).alias("fx"),
        S.bucket(
            F.when(F.col("p_partkey") % 9 != 0, F.col("p_size")), *S.INTEREST_LIMITS, S.ROW_INTEREST_LABELS
        ).alias("interest"),
        S.bucket(F.col("p_size") / 10.0, 3.5, None, S.STRENGTH_LABELS).alias("strength"),
    )
)
query(
    "x18_parse_date",
    "SELECT event_id, CAST(ts AS DATE) AS day FROM events",
)(
    lambda e: e.table("events").select(
        "event_id", S.parse_day_first(F.date_format("ts", "dd/MM/yyyy")).alias("day")
    )
)
NOW = "2024-02-15 12:30:00"
query(
    "x20_elapsed",
    f"""SELECT event_id, date_sub('hour', ts, TIMESTAMP '{NOW}') AS hours,
               date_sub('minute', ts, TIMESTAMP '{NOW}') AS minutes FROM events""",
)(
    lambda e: e.table("events").select(
        "event_id",
        S.elapsed("HOUR", F.col("ts").cast("timestamp"), F.lit(NOW).cast("timestamp")).alias("hours"),
        S.elapsed("MINUTE", F.col("ts").cast("timestamp"), F.lit(NOW).cast("timestamp")).alias("minutes"),
    )
)

# ---- checks --------------------------------------------------------------------------

query(
    "q1_unique",
    """SELECT order_id, order_item_id, count(*) AS n_records FROM e_items GROUP BY ALL HAVING count(*) > 1""",
)(lambda e: quality.unique(e.items, ["order_id", "order_item_id"]))
query("q2_not_null", "SELECT order_id, order_status FROM e_orders WHERE order_approved_at IS NULL")(
    lambda e: quality.not_null(e.orders, "order_approved_at").select("order_id", "order_status")
)
query(
    "q3_accepted_values",
    "SELECT order_id, order_status FROM e_orders WHERE order_status NOT IN ('delivered', 'shipped')",
)(
    lambda e: quality.accepted_values(
        e.orders.select("order_id", "order_status"), "order_status", ["delivered", "shipped"]
    )
)
query(
    "q4_relationships",
    """SELECT product_id, count(*) AS row_count FROM e_items
       WHERE product_id NOT IN (SELECT product_id FROM e_products) GROUP BY 1""",
)(
    lambda e: quality.relationships(e.items, "product_id", e.products, "product_id")
    .groupBy("product_id").agg(F.count("*").alias("row_count"))
)
query("q5_expression", "SELECT order_id FROM e_orders WHERE NOT order_purchase_timestamp >= '2000-01-01'")(
    lambda e: quality.expression_is_true(e.orders, "order_purchase_timestamp >= '2000-01-01'").select("order_id")
)
query(
    "q6_temporal",
    """SELECT order_id FROM e_orders
       WHERE NOT (order_delivered_customer_date >= order_delivered_carrier_date)""",
)(
    lambda e: quality.expression_is_true(
        e.orders, "order_delivered_customer_date >= order_delivered_carrier_date"
    ).select("order_id")
)
query(
    "q7_valid_numeric",
    """SELECT 'Data type violation detected' AS error_message,
              count(*) - count(product_weight_g) AS invalid_rows, count(*) AS total_rows
       FROM e_products HAVING count(*) > count(product_weight_g)""",
)(lambda e: quality.valid_numeric(e.products, "product_weight_g"))
query(
    "q9_in_range",
    """SELECT category_name, category_name_pt, order_month, customer_state, avg_exchange_rate FROM m_cat
       WHERE NOT avg_exchange_rate BETWEEN 3.0 AND 6.0""",
    MARTS,
)(
    lambda e: quality.in_range(d3(e), "avg_exchange_rate", 3.0, 6.0).select(
        "category_name", "category_name_pt", "order_month", "customer_state", "avg_exchange_rate"
    )
)


def staged(e: Entities) -> dict[str, DataFrame]:
    return {
        "stg_orders": e.orders,
        "stg_order_items": e.items,
        "stg_customers": e.customers,
        "stg_products": e.products,
        "stg_payments": staging.strict_payments(e.raw_payments),
    }


def twin(declared, names: dict[str, str]) -> str:
    """The declared checks as one SQL statement, each a count of its own."""
    parts = []
    for c in declared:
        table, col = names[c.table], c.column
        if c.kind == "unique":
            keys = ", ".join(c.arg or [col])
            known = " AND ".join(f"{k} IS NOT NULL" for k in c.arg or [col])
            count = (f"(SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {known} "
                     f"GROUP BY {keys} HAVING count(*) > 1))")
        elif c.kind == "relationships":
            count = (f"(SELECT count(*) FROM {table} x WHERE {col} IS NOT NULL AND NOT EXISTS "
                     f"(SELECT 1 FROM {names[c.arg[0]]} y WHERE y.{c.arg[1]} = x.{col}))")
        else:
            rule = {
                "not_null": f"{col} IS NULL",
                "accepted_values": f"{col} NOT IN {c.arg}",
                "expression": f"NOT ({c.arg})",
                "range": f"NOT {col} BETWEEN {c.arg[0]} AND {c.arg[1]}" if c.kind == "range" else "",
            }[c.kind]
            count = f"(SELECT count(*) FROM {table} WHERE {rule})"
        name = c.name.replace("'", "''")
        parts.append(
            f"SELECT '{name}' AS check_name, '{c.table}' AS table_name, '{col}' AS column_name, "
            f"'{c.severity}' AS severity, CAST({count} AS BIGINT) AS failures"
        )
    return " UNION ALL\n".join(parts)


OUTCOME = """SELECT *, CASE WHEN failures = 0 THEN 'PASS' WHEN severity = 'error' THEN 'ERROR' ELSE 'WARN' END
             AS outcome FROM ({})"""
STAGED = {
    "stg_orders": "e_orders", "stg_order_items": "e_items", "stg_customers": "e_customers",
    "stg_products": "k_products", "stg_payments": "e_payments",
}
K_PRODUCTS = {"k_products": "SELECT *, product_name_lenght AS product_name_length FROM e_products"}
CHECKED = OUTCOME.format(twin(checks.STAGING_CHECKS, STAGED))
GATE = """SELECT count(*) FILTER (outcome = 'PASS') AS passed, count(*) FILTER (outcome = 'WARN') AS warned,
                 count(*) FILTER (outcome = 'ERROR') AS errors, count(*) AS total,
                 CASE WHEN count(*) FILTER (outcome = 'ERROR') > 0 THEN 'FAILED'
                      WHEN count(*) FILTER (outcome = 'WARN') > 0 THEN 'WARNING' ELSE 'SUCCESS' END AS status
          FROM ({})"""
query("q8_run_checks", CHECKED, K_PRODUCTS)(lambda e: quality.run_checks(staged(e), checks.STAGING_CHECKS))
query("q8_gate", GATE.format(CHECKED), K_PRODUCTS)(
    lambda e: quality.gate(quality.run_checks(staged(e), checks.STAGING_CHECKS))
)
STARRED = {
    "stg_customers": "t6", "stg_orders": "t7", "stg_order_items": "t9", "stg_payments": "e_payments",
    "stg_reviews": "e_reviews", "stg_products": "t11", "stg_sellers": "t12", "fact_orders": "d7",
    "fact_reviews": "d8", "dim_customers": "t6", "dim_products": "t11", "dim_sellers": "t12",
}


@query("q8_star_checks", OUTCOME.format(twin(checks.STAR_CHECKS, STARRED)), STAR | LISTS | {"d7": D7, "d8": D8})
def _(e: Entities):
    # Checks read stored tables: the facts and the repeated customers are written once, equal rows
    # of them as one row with their number.
    people = keep(t6(e, COPIES), "customers")
    facts, reviews = keep(d7(e, people), "facts"), keep(d8(e), "reviews")
    return quality.run_checks(
        {
            "stg_customers": people,
            "stg_orders": t7(e),
            "stg_order_items": t9(e),
            "stg_payments": staging.strict_payments(e.raw_payments),
            "stg_reviews": staging.strict_reviews(e.raw_reviews),
            "stg_products": t11(e),
            "stg_sellers": t12(e),
            "fact_orders": facts,
            "fact_reviews": reviews,
            "dim_customers": star.dim_customers(people, COPIES),
            "dim_products": star.dim_products(t11(e)),
            "dim_sellers": star.dim_sellers(t12(e)),
        },
        checks.STAR_CHECKS,
        dict.fromkeys(("stg_customers", "fact_orders", "dim_customers"), COPIES),
    )


query("q9_mart_checks", OUTCOME.format(twin(checks.MART_CHECKS, {"fct_category": "m_cat"})), MARTS)(
    lambda e: quality.run_checks({"fct_category": d3(e)}, checks.MART_CHECKS)
)
query(
    "q10_freshness",
    f"""SELECT max(extracted_at) AS last_update,
               date_sub('hour', max(extracted_at), TIMESTAMP '{NOW}') AS hours_old,
               date_sub('hour', max(extracted_at), TIMESTAMP '{NOW}') > 24 AS is_stale FROM e_series""",
)(
    lambda e: plain_times(
        quality.freshness(
            e.series.withColumn("extracted_at", F.col("extracted_at").cast("timestamp")),
            "extracted_at", F.lit(NOW).cast("timestamp"),
        )
    )
)
query("q11_recency")(
    lambda e: quality.recency(
        e.spark, {n: f"{e.folder}/{n}.parquet" for n in NAMES}, F.current_timestamp()
    )
)
query(
    "q12_run_report",
    f"""SELECT (SELECT count(*) FROM (VALUES (1), (2)))  AS tables_built,
               (SELECT count(*) FROM m_cat) + (SELECT count(*) FROM m_geo) AS total_rows,
               (SELECT status FROM ({GATE.format(OUTCOME.format(twin(checks.MART_CHECKS, {"fct_category": "m_cat"})))}))
                 AS status""",
    MARTS,
)(
    lambda e: quality.run_report(
        profile.row_counts({"fct_category": d3(e), "fct_geo": d4(e)}),
        quality.run_checks({"fct_category": d3(e)}, checks.MART_CHECKS),
    )
)
query(
    "q13_completeness",
    f"""SELECT CAST({' + '.join(f'count({c})' for c in ORDER_COLUMNS)} AS DOUBLE)
               / (count(*) * {len(ORDER_COLUMNS)}) AS completeness FROM e_orders""",
)(lambda e: profile.completeness(e.orders))

# ---- readers and writers -------------------------------------------------------------


@query(
    "s1_csv_entities",
    """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_status,
              strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp,
              CAST(review_id AS VARCHAR) AS review_id, CAST(review_score AS VARCHAR) AS review_score,
              'line one' || chr(10) || 'line "two", ' || review_id AS review_comment_message
       FROM e_orders LEFT JOIN e_reviews USING (order_id)""",
)
def _(e: Entities):
    root = scratch_path(e.spark, "csv")
    wrote = {
        "raw_orders": e.raw_orders,
        "raw_order_reviews": e.raw_reviews.withColumn(
            "review_comment_message", F.concat(F.lit('line one\nline "two", '), "review_id")
        ),
    }
    for name, df in wrote.items():
        spec = tables.ENTITIES[name]
        times = {
            f.name: F.date_format(f.name, "yyyy-MM-dd HH:mm:ss")
            for f in df.schema if f.dataType.typeName().startswith("timestamp")
        }
        df.withColumns(times).select(*spec.columns).write.option("header", True).option("escape", '"').csv(
            f"{root}/{spec.path.replace('*', 'raw_')}"
        )
    read = tables.read_entities(e.spark, root, {n: tables.ENTITIES[n] for n in wrote})
    orders = read["raw_orders"].select("order_id", "customer_id", "order_status", "order_purchase_timestamp")
    reviews = read["raw_order_reviews"].select("order_id", "review_id", "review_score", "review_comment_message")
    return orders.join(reviews, "order_id", "left")


@query(
    "s2_csv_load",
    """SELECT CAST(event_id AS INTEGER) AS event_id, event_type,
              CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_timestamp,
              CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS load_date
       FROM events""",
)
def _(e: Entities):
    root = scratch_path(e.spark, "load")
    e.table("events").select(
        "event_id", "event_type",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_timestamp"),
        F.when(F.col("event_id") % 3 == 0, "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("load_date"),
    ).write.option("header", True).csv(f"{root}/in")
    return plain_times(tables.load_csv(e.spark, f"{root}/in", f"{root}/out", multi_line=False))


SERIES_OF = {"click": "exchange_rate_usd", "error": "ipca", "purchase": "selic", "signup": "igpm",
             "view": "exchange_commercial"}


@query(
    "s4_s5_indicator_json",
    f"""SELECT CAST(ts AS DATE) AS data, CASE WHEN event_id % 7 <> 0 THEN value END AS valor,
               CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SERIES_OF.items())} END AS series_name,
               CAST(CASE event_type {' '.join(f"WHEN '{k}' THEN {series.SERIES[v]}" for k, v in SERIES_OF.items())}
                    END AS BIGINT) AS series_id
        FROM events WHERE ts >= TIMESTAMP '2024-01-10'""",
)
def _(e: Entities):
    """All five series written as JSON records, read back one by one and put together."""
    root = scratch_path(e.spark, "json")
    e.table("events").select(
        "event_type",
        F.date_format("ts", "dd/MM/yyyy").alias("data"),
        F.when(F.col("event_id") % 7 != 0, F.col("value").cast("string")).otherwise("n/d").alias("valor"),
    ).write.partitionBy("event_type").json(root)
    return series.union_series(
        [
            series.read_indicator_series(e.spark, f"{root}/event_type={kind}", name, start="10/01/2024")
            for kind, name in SERIES_OF.items()
        ]
    ).drop("extracted_at")


query(
    "u1_union",
    "SELECT series_name, count(*) AS records FROM e_series GROUP BY 1",
)(
    lambda e: series.union_series(
        [e.series.where(F.col("series_name") == n) for n in EVENT_SERIES] + [None]
    ).groupBy("series_name").agg(F.count("*").alias("records"))
)


@query(
    "s6_write_table",
    """SELECT data, valor, series_name, series_id FROM e_series
       UNION ALL SELECT data, valor, series_name, series_id FROM e_series""",
)
def _(e: Entities):
    path = scratch_path(e.spark, "sink")
    tables.write_table(e.series, path, tables.INDICATOR_SCHEMA)
    tables.write_table(e.series, path, tables.INDICATOR_SCHEMA, "WRITE_TRUNCATE")
    tables.write_table(e.series, path, tables.INDICATOR_SCHEMA, "WRITE_APPEND")
    return e.spark.read.parquet(path).drop("extracted_at")


@query("s7_materialize", f"SELECT {CAT_COLUMNS} FROM m_cat", MARTS)
def _(e: Entities):
    tables.materialize(e.orders, "tradewind_stg_orders", "view")
    e.orders = e.spark.table("tradewind_stg_orders")
    return tables.materialize(
        d3(e).select(*[c.strip() for c in CAT_COLUMNS.split(",")]), "tradewind_category", "table",
        scratch_path(e.spark, "table"),
    )


@query(
    "s8_source_catalogue",
    """SELECT 'orders' AS table_name, count(*) AS row_count FROM e_orders
       UNION ALL SELECT 'order_items', count(*) FROM e_items""",
)
def _(e: Entities):
    root = scratch_path(e.spark, "sources")
    for name, df in {"orders": e.raw_orders, "order_items": e.raw_items}.items():
        df.write.parquet(f"{root}/{tables.SOURCES[name]}")
    return profile.row_counts(tables.read_sources(e.spark, root, ("orders", "order_items")), total=False)


@query(
    "d1_d4_full_run",
    """SELECT 'fct_orders_with_economics' AS table_name, count(*) AS row_count FROM m_orders
       UNION ALL SELECT 'fct_customer_purchases_economics', count(*) FROM m_items
       UNION ALL SELECT 'fct_category_performance_economics', count(*) FROM m_cat
       UNION ALL SELECT 'fct_geographic_sales_economics', count(*) FROM m_geo""",
    MARTS,
)
def _(e: Entities):
    """Staging, marts, checks and report in one run; the rows of the stored marts."""
    raw = {
        "orders": e.raw_orders, "order_items": e.raw_items, "customers": e.raw_customers,
        "products": e.raw_products, "payments": e.raw_payments, "indicators": e.raw_indicators,
    }
    stored, _, _ = build.run_all(e.spark, raw, e.lookup, scratch_path(e.spark, "run"))
    return profile.row_counts(stored, total=False)


def stored_mart(e: Entities, name: str) -> DataFrame:
    """A grouped mart as the whole run stores it: added up again from the sales cube."""
    raw = {
        "orders": e.raw_orders, "order_items": e.raw_items, "customers": e.raw_customers,
        "products": e.raw_products, "payments": e.raw_payments, "indicators": e.raw_indicators,
    }
    return build.build_marts(build.stage(raw), e.lookup)[name]


query("d3_category_stored", D3)(lambda e: stored_mart(e, "fct_category_performance_economics"))
query("d4_geo_stored", D4)(lambda e: stored_mart(e, "fct_geographic_sales_economics"))


# ---- stream --------------------------------------------------------------------------

WINDOWS = """SELECT time_bucket(INTERVAL 60 MINUTE, ts) AS window_start, event_type, count(*) AS events,
                    CAST(sum(CAST(value AS DECIMAL(18, 6))) AS DOUBLE) AS total
             FROM events GROUP BY ALL"""


def event_rows(df: DataFrame) -> DataFrame:
    return df.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")


query("r6_event_windows", WINDOWS)(
    lambda e: plain_times(intake.windowed_totals(event_rows(e.table("events")), width="1 hour"))
)


@query("r6_event_stream", WINDOWS)
def _(e: Entities):
    events = (
        e.spark.readStream.schema(e.table("events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(e.folder)
    )
    out = scratch_path(e.spark, "stream")
    intake.run_intake(
        intake.windowed_totals(event_rows(events), width="1 hour"), f"{out}/totals", f"{out}/checkpoint"
    )
    return plain_times(intake.latest_totals(e.spark.read.parquet(f"{out}/totals")))
