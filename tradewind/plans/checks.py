"""The declared data tests, as data."""

from __future__ import annotations

from tradewind.operators.quality import Check

# Allowed order statuses and payment types.
STATUSES = (
    "delivered", "shipped", "processing", "canceled", "approved", "invoiced", "created", "unavailable",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")


def _table(table: str, *rules) -> list[Check]:
    return [Check(table, *rule) for rule in rules]


def _or_null(column: str, rule: str) -> str:
    return f"{column} {rule} OR {column} IS NULL"


STAGING_CHECKS = [
    *_table(
        "stg_orders",
        ("order_id", "unique", "error"),
        ("order_id", "not_null", "error"),
        ("customer_id", "not_null"),
        ("customer_id", "relationships", "warn", ("stg_customers", "customer_id")),
        ("order_status", "not_null"),
        ("order_status", "accepted_values", "warn", STATUSES),
        ("order_purchase_timestamp", "not_null"),
        ("order_purchase_timestamp", "expression", "error", "order_purchase_timestamp >= '2000-01-01'"),
        (
            "order_delivered_customer_date", "expression", "warn",
            _or_null("order_delivered_customer_date", ">= order_purchase_timestamp"),
        ),
    ),
    *_table(
        "stg_order_items",
        ("order_id", "not_null", "error"),
        ("order_id", "relationships", "warn", ("stg_orders", "order_id")),
        ("order_item_id", "not_null", "error"),
        ("product_id", "not_null"),
        ("product_id", "relationships", "warn", ("stg_products", "product_id")),
        ("seller_id", "not_null"),
        ("price", "not_null"),
        ("price", "expression", "error", "price >= 0"),
        ("price", "expression", "warn", "price < 1000000"),
        ("freight_value", "not_null"),
        ("freight_value", "expression", "error", "freight_value >= 0"),
    ),
    *_table(
        "stg_payments",
        ("order_id", "not_null", "error"),
        ("order_id", "relationships", "warn", ("stg_orders", "order_id")),
        ("payment_sequential", "not_null", "error"),
        ("payment_sequential", "expression", "error", "payment_sequential >= 1"),
        ("payment_type", "not_null"),
        ("payment_type", "accepted_values", "warn", PAYMENT_TYPES),
        ("payment_installments", "not_null"),
        ("payment_installments", "expression", "error", "payment_installments >= 0"),
        ("payment_installments", "expression", "warn", "payment_installments <= 24"),
        ("payment_value", "not_null"),
        ("payment_value", "expression", "error", "payment_value > 0"),
    ),
    *_table(
        "stg_customers",
        ("customer_id", "unique", "error"),
        ("customer_id", "not_null", "error"),
        ("customer_unique_id", "not_null"),
        ("customer_zip_code_prefix", "not_null"),
        ("customer_city", "not_null"),
        ("customer_state", "not_null"),
        ("customer_state", "expression", "warn", "LENGTH(customer_state) = 2 OR customer_state IS NULL"),
    ),
    *_table(
        "stg_products",
        ("product_id", "unique", "error"),
        ("product_id", "not_null", "error"),
        ("product_category_name", "not_null"),
        ("product_name_length", "expression", "error", _or_null("product_name_length", ">= 0")),
        ("product_weight_g", "expression", "error", _or_null("product_weight_g", "> 0")),
        ("product_weight_g", "expression", "warn", _or_null("product_weight_g", "< 100000")),
        ("product_length_cm", "expression", "error", _or_null("product_length_cm", "> 0")),
        ("product_height_cm", "expression", "error", _or_null("product_height_cm", "> 0")),
        ("product_width_cm", "expression", "error", _or_null("product_width_cm", "> 0")),
    ),
]


def _key(table: str, column: str) -> list[Check]:
    return _table(table, (column, "unique"), (column, "not_null"))


def _link(table: str, column: str, parent: str, required: bool = True) -> list[Check]:
    link = (column, "relationships", "warn", (parent, column))
    return _table(table, (column, "not_null"), link) if required else _table(table, link)


STAR_CHECKS = [
    *_key("stg_customers", "customer_id"),
    *_table("stg_customers", ("customer_unique_id", "not_null")),
    *_key("stg_orders", "order_id"),
    *_link("stg_orders", "customer_id", "stg_customers"),
    *_link("stg_order_items", "order_id", "stg_orders"),
    *_link("stg_order_items", "product_id", "stg_products"),
    *_link("stg_payments", "order_id", "stg_orders"),
    *_link("stg_reviews", "order_id", "stg_orders"),
    *_key("stg_products", "product_id"),
    *_key("stg_sellers", "seller_id"),
    *_key("fact_orders", "order_id"),
    *_link("fact_orders", "customer_id", "dim_customers"),
    *_link("fact_orders", "product_id", "dim_products", required=False),
    *_link("fact_orders", "seller_id", "dim_sellers", required=False),
    *_key("fact_reviews", "order_id"),
    *_link("fact_reviews", "customer_id", "dim_customers"),
    *_key("dim_customers", "customer_id"),
    *_key("dim_products", "product_id"),
    *_key("dim_sellers", "seller_id"),
]

# The documented checks on the category mart; its key is the combination of four columns.
MART_CHECKS = _table(
    "fct_category",
    ("category_name", "unique", "warn", ["category_name", "category_name_pt", "order_month", "customer_state"]),
    ("category_name", "not_null"),
    ("order_count", "not_null"),
    ("total_revenue_usd", "not_null"),
    ("avg_exchange_rate", "not_null"),
    ("order_count", "expression", "warn", "order_count > 0"),
    ("total_revenue_usd", "expression", "warn", "total_revenue_usd >= 0"),
    ("avg_exchange_rate", "range", "warn", (3.0, 6.0)),
    ("exchange_rate_period", "accepted_values", "warn", ("Strong BRL", "Moderate BRL", "Weak BRL")),
)
