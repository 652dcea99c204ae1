"""Staging layer: typed, cleaned and deduplicated copies of the raw tables.

Casts run in ANSI mode, so malformed text fails the job instead of turning NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions import clean_code, clean_place, rounded_ratio
from bazaarlens.operators.latest import latest_per_key
from bazaarlens.operators.modal import aggregate_with_modes, ballot
from bazaarlens.schemas import COORDINATE, MEASURE, MONEY, TIMESTAMP


def _typed(df: DataFrame, kinds: dict[str, object]) -> DataFrame:
    return df.select(
        *[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns]
    )


def customers(raw: DataFrame) -> DataFrame:
    """One row per customer account."""
    return raw.withColumns(
        {
            "customer_city": clean_place(F.col("customer_city")),
            "customer_state": clean_code(F.col("customer_state")),
        }
    )


def orders(raw: DataFrame) -> DataFrame:
    """One row per order with its five moments as timestamps."""
    moments = [c for c in raw.columns if c not in ("order_id", "customer_id", "order_status")]
    return _typed(raw, dict.fromkeys(moments, TIMESTAMP))


def order_items(raw: DataFrame) -> DataFrame:
    """One row per item of an order."""
    return _typed(
        raw,
        {
            "order_item_id": "int",
            "shipping_limit_date": TIMESTAMP,
            "price": MONEY,
            "freight_value": MONEY,
        },
    )


def order_payments(raw: DataFrame) -> DataFrame:
    """One row per payment of an order."""
    return _typed(
        raw,
        {"payment_sequential": "int", "payment_installments": "int", "payment_value": MONEY},
    )


def order_reviews(raw: DataFrame) -> DataFrame:
    """One row per reviewed order: its latest review."""
    typed = _typed(
        raw,
        {
            "review_score": "int",
            "review_creation_date": TIMESTAMP,
            "review_answer_timestamp": TIMESTAMP,
        },
    )
    return latest_per_key(typed, "order_id", "review_creation_date", "review_id")


def products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """One row per product, its category in English where a translation exists.

    The translation is not marked for broadcast: the engine broadcasts it when
    its measured size allows and shuffles it otherwise.
    """
    english = translation.select(
        F.col("product_category_name").alias("_local"),
        F.col("product_category_name_english").alias("_english"),
    )
    local = F.col("product_category_name")

    def number(name: str, kind: object) -> Column:
        return F.nullif(F.col(name), F.lit("")).cast(kind).alias(name)

    return raw.join(english, local == F.col("_local"), "left").select(
        "product_id",
        F.coalesce("_english", local, F.lit("unknown")).alias("product_category"),
        number("product_name_length", "int"),
        number("product_description_length", "int"),
        number("product_photos_qty", "int"),
        number("product_weight_g", MEASURE),
        number("product_length_cm", MEASURE),
        number("product_height_cm", MEASURE),
        number("product_width_cm", MEASURE),
    )


def sellers(raw: DataFrame) -> DataFrame:
    """One row per seller."""
    return raw.withColumns(
        {
            "seller_city": clean_place(F.col("seller_city")),
            "seller_state": clean_code(F.col("seller_state")),
        }
    )


def geolocation(raw: DataFrame) -> DataFrame:
    """One row per zip prefix: mean position, most frequent city and state."""
    latitude = F.col("geolocation_lat").cast(COORDINATE)
    longitude = F.col("geolocation_lng").cast(COORDINATE)
    one = F.lit(1)
    points = aggregate_with_modes(
        raw.withColumnRenamed("geolocation_zip_code_prefix", "zip_code_prefix"),
        "zip_code_prefix",
        F.array(
            ballot("city", clean_place(F.col("geolocation_city")), one),
            ballot("state", clean_code(F.col("geolocation_state")), one),
        ),
        ("city", "state"),
        {
            "_lat": latitude,
            "_lat_rows": F.when(latitude.isNotNull(), one),
            "_lng": longitude,
            "_lng_rows": F.when(longitude.isNotNull(), one),
        },
    )
    scale = COORDINATE.scale
    return points.select(
        "zip_code_prefix",
        rounded_ratio(F.col("_lat"), F.col("_lat_rows"), 6, numerator_scale=scale).alias(
            "latitude"
        ),
        rounded_ratio(F.col("_lng"), F.col("_lng_rows"), 6, numerator_scale=scale).alias(
            "longitude"
        ),
        "city",
        "state",
    )
