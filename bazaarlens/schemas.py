"""Declared shapes of the nine raw extracts. Raw columns are all text."""

from __future__ import annotations

from pyspark.sql.types import DecimalType, StringType, StructField, StructType, TimestampNTZType

# Table and column names of the raw extracts, in file order.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
    "orders": (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "order_items": (
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
    "order_payments": (
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ),
    "order_reviews": (
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ),
    "products": (
        "product_id",
        "product_category_name",
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "sellers": (
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    ),
    "geolocation": (
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ),
    "category_translation": (
        "product_category_name",
        "product_category_name_english",
    ),
}

#: Only free-text review columns may hold line breaks inside a quoted field.
MULTILINE_TABLES = frozenset({"order_reviews"})

# Column types used from staging onwards.
TIMESTAMP = TimestampNTZType()
MONEY = DecimalType(10, 2)
MEASURE = DecimalType(18, 4)
COORDINATE = DecimalType(20, 15)


def raw_schema(table: str) -> StructType:
    """All-text schema of one raw extract."""
    return StructType([StructField(name, StringType()) for name in RAW_COLUMNS[table]])
