"""Mart layer: five business views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from bazaarlens.functions import (
    MICROS_PER_DAY,
    falling,
    percentage,
    rising,
    rounded_ratio,
    span_micros,
)
from bazaarlens.operators.bitmaps import numbered_lists, sums_and_distinct
from bazaarlens.operators.placement import SortKey, ntile_columns, with_rows_ahead
from bazaarlens.plans import monthly
from bazaarlens.sources.buckets import Dealt, dealt

_MICROS = DecimalType(18, 0)
_TIMES = DecimalType(13, 0)


def delivery_micros() -> Column:
    """Purchase to delivery, as a whole number that sums exactly."""
    return span_micros(
        F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    ).cast(_MICROS)


def mean_days(micros: Column) -> Column:
    """Mean of microsecond spans in days, rounded to one place."""
    per_day = F.lit(MICROS_PER_DAY).cast(_MICROS)
    return rounded_ratio(F.sum(micros), F.count(micros).cast(_TIMES) * per_day, 1)


def mean_of(amount: Column, *, scale: int = 0, digits: int = 2) -> Column:
    """Mean rounded once to ``digits`` places."""
    return rounded_ratio(F.sum(amount), F.count(amount), digits, numerator_scale=scale)


def share_where(condition: Column) -> Column:
    """Percentage of the group's rows that satisfy ``condition``."""
    return percentage(F.count_if(condition), F.count(F.lit(1)))


def monthly_revenue(enriched: DataFrame) -> DataFrame:
    """Delivered orders per purchase month, from all orders; see ``monthly``."""
    return monthly.monthly_revenue(*monthly.states_of(enriched))


def state_performance(enriched: DataFrame) -> DataFrame:
    """Delivered orders per customer state, from all orders; see ``monthly``."""
    return monthly.state_performance(*monthly.states_of(enriched))


def product_category_analysis(
    items: DataFrame | Dealt, products: DataFrame, enriched: DataFrame, *, min_orders: int = 10
) -> DataFrame:
    """Delivered sales per category with at least ``min_orders`` orders.

    Review and delivery averages are weighted per item. Sellers and products are counted
    by bitmaps in the pass that sums up the rest; no order's sellers or products are
    gathered, so all of it is done by hash aggregates. Products are numbered by category, so
    that a category's products fill few bitmaps.
    """
    orders = enriched.filter(F.col("order_status") == "delivered").select(
        "order_id",
        "review_score",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
    )
    sold_by = dealt(items).rows().select(F.col("seller_id").alias("id"))
    kinds, sellers = numbered_lists(
        products.selectExpr("product_id AS id", "product_category AS near"),
        sold_by.filter(F.col("id").isNotNull()).distinct(),
    )
    kinds = kinds.withColumnsRenamed(
        {"id": "product_id", "near": "product_category", "_number": "_product"}
    )
    sellers = sellers.withColumnsRenamed({"id": "seller_id", "_number": "_seller"})

    def lines(part: DataFrame) -> DataFrame:
        return (
            part.select("order_id", "product_id", "seller_id", "price")
            .join(orders, "order_id")
            .join(kinds, "product_id")
            .join(sellers, "seller_id", "left")
        )

    price, review, micros = F.col("price"), F.col("review_score"), delivery_micros()
    facts = dealt(items).each(lines).select(
        "product_category",
        "order_id",
        "_seller",
        "_product",
        price.alias("_price"),
        price.isNotNull().cast("long").alias("_priced"),
        review.cast("long").alias("_review"),
        review.isNotNull().cast("long").alias("_reviewed"),
        micros.alias("_micros"),
        micros.isNotNull().cast("long").alias("_delivered"),
    )
    # A line's sums go by category and order, so counting orders is counting rows.
    added = ("_price", "_priced", "_review", "_reviewed", "_micros", "_delivered")
    totals = sums_and_distinct(
        facts,
        "product_category",
        {name: name for name in added},
        {"seller_count": "_seller", "product_count": "_product"},
        ("total_orders", "order_id"),
    )
    days = F.col("_delivered").cast(_TIMES) * F.lit(MICROS_PER_DAY).cast(_MICROS)
    return (
        totals.filter(F.col("total_orders") >= min_orders)
        .select(
            "product_category",
            "total_orders",
            F.col("_price").cast(DecimalType(20, 2)).alias("total_revenue"),
            rounded_ratio(F.col("_price"), F.col("_priced"), 2, numerator_scale=2).alias("avg_price"),
            "seller_count",
            "product_count",
            rounded_ratio(F.col("_review"), F.col("_reviewed"), 2).alias("avg_review_score"),
            rounded_ratio(F.col("_micros"), days, 1).alias("avg_delivery_days"),
        )
        .orderBy(falling("total_revenue"))
    )


def seller_scorecard(sellers: DataFrame) -> DataFrame:
    """Sellers with orders: percent ranks of revenue, review and speed, and a tier.

    A missing review average ranks above all others; missing delivery days give
    speed 0. A seller without reviews can still be bronze.
    """
    selling = sellers.filter(F.col("total_orders") > 0).select(
        "seller_id",
        "seller_city",
        "seller_state",
        "total_orders",
        "total_revenue",
        "avg_review_score",
        "avg_delivery_days",
    )
    ranked, count = with_rows_ahead(
        selling,
        {
            "revenue_percentile": SortKey("total_revenue"),
            "review_percentile": SortKey("avg_review_score"),
            "delivery_speed_percentile": SortKey(
                "avg_delivery_days", descending=True, nulls_first=True
            ),
        },
    )

    def percent_rank(ahead: str) -> Column:
        if count <= 1:
            rank = F.lit(0).cast(DecimalType(23, 3))
        else:
            rank = rounded_ratio(F.col(ahead), F.lit(count - 1), 3)
        return rank.alias(ahead)

    orders, review = F.col("total_orders"), F.col("avg_review_score")
    # The thresholds of the tiers.
    tier = (
        F.when((orders >= 50) & (review >= 4), "gold")
        .when((orders >= 20) & (review >= F.lit("3.5").cast("decimal(2,1)")), "silver")
        .when(orders >= 5, "bronze")
        .otherwise("new")
    )
    return ranked.select(
        *selling.columns,
        percent_rank("revenue_percentile"),
        percent_rank("review_percentile"),
        percent_rank("delivery_speed_percentile"),
        tier.alias("seller_tier"),
    ).orderBy(falling("total_revenue"), rising("seller_id"))


def customer_segments(history: DataFrame, orders: DataFrame) -> DataFrame:
    """Recency, frequency and value quintiles per person, and a segment.

    Ties inside a quintile ordering go by ``customer_unique_id``. The segment is
    the first matching case.
    """
    people = history.filter(F.col("lifetime_orders") > 0)
    quintiles = ntile_columns(
        people,
        5,
        "customer_unique_id",
        {
            # Longest ago first, which is recency in descending order.
            "recency_quintile": SortKey("last_order_date", nulls_first=True),
            "frequency_quintile": SortKey("lifetime_orders"),
            "monetary_quintile": SortKey("lifetime_value"),
        },
    )
    latest = orders.agg(F.max("order_purchase_timestamp")).scalar()
    recency_micros = span_micros(F.col("last_order_date"), latest)
    recency = F.col("recency_quintile")
    frequency = F.col("frequency_quintile")
    monetary = F.col("monetary_quintile")
    # The segment rule, first matching case.
    segment = (
        F.when((recency >= 4) & (frequency >= 4) & (monetary >= 4), "champions")
        .when((recency >= 4) & (frequency >= 3), "loyal")
        .when((recency >= 4) & (monetary >= 4), "big_spenders")
        .when(recency >= 4, "recent")
        .when(frequency >= 4, "frequent")
        .when((recency <= 2) & (frequency <= 2), "at_risk")
        .otherwise("regular")
    )
    return people.select(
        "customer_unique_id",
        "lifetime_orders",
        "lifetime_value",
        rounded_ratio(F.col("avg_order_value"), F.lit(1), 2, numerator_scale=16).alias(
            "avg_order_value"
        ),
        "avg_review_score",
        "first_order_date",
        "last_order_date",
        rounded_ratio(recency_micros, F.lit(MICROS_PER_DAY), 0).alias("recency_days"),
        "is_repeat_customer",
        "preferred_payment_method",
        "primary_state",
        *[column.alias(name) for name, column in quintiles.items()],
    ).withColumn("customer_segment", segment)
