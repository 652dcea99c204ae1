"""Intermediate layer: enriched orders and seller, product and person profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from bazaarlens.functions import (
    MICROS_PER_DAY,
    day_name_padded,
    mean_money,
    rounded_ratio,
    span_days,
    span_micros,
)
from bazaarlens.operators.modal import aggregate_with_modes, ballot
from bazaarlens.sources.buckets import Dealt, dealt

_MICROS = DecimalType(18, 0)  # decimal, because long sums of microseconds overflow
_TIMES = DecimalType(13, 0)


def item_rollup(items: DataFrame | Dealt) -> DataFrame:
    """Item count, product variety and value per order."""
    return dealt(items).each(
        lambda part: part.groupBy("order_id").agg(
            F.count(F.lit(1)).alias("total_items"),
            F.count_distinct("product_id").alias("total_products"),
            F.sum("price").alias("total_price"),
            F.sum("freight_value").alias("total_freight"),
        )
    )


def payment_rollup(payments: DataFrame | Dealt) -> DataFrame:
    """Paid value, sorted list of distinct methods and most instalments per order."""
    methods = F.array_sort(F.collect_set("payment_type"))
    return dealt(payments).each(
        lambda part: part.groupBy("order_id").agg(
            F.sum("payment_value").alias("total_payment_value"),
            F.when(F.size(methods) > 0, F.array_join(methods, ", ")).alias("payment_methods"),
            F.max("payment_installments").alias("max_installments"),
        )
    )


def delivery_status() -> Column:
    """Delivered by the estimate, after it, or (either date missing) not delivered.

    The order status plays no part.
    """
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    return (
        F.when(delivered <= estimated, "on_time")
        .when(delivered > estimated, "late")
        .otherwise("not_delivered")
    )


def orders_enriched(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame | Dealt,
    payments: DataFrame | Dealt,
    reviews: DataFrame,
) -> DataFrame:
    """One row per order with customer, value, payment, review and delivery facts.

    Items and payments are reduced to one row per order before they are joined. The
    joins by order come first: over tables in buckets they move nothing, and only the
    join with the customers shuffles. An order without items keeps a NULL value, not
    zero.
    """
    people = customers.select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state"
    )
    scores = reviews.select("order_id", "review_score")
    joined = (
        orders.join(item_rollup(items), "order_id", "left")
        .join(payment_rollup(payments), "order_id", "left")
        .join(scores, "order_id", "left")
        .join(people, "customer_id", "left")
    )
    bought = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    return joined.select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        bought.cast("date").alias("order_date"),
        F.year(bought).alias("order_year"),
        F.month(bought).alias("order_month"),
        day_name_padded(bought).alias("order_day_of_week"),
        "total_items",
        "total_products",
        "total_price",
        "total_freight",
        (F.col("total_price") + F.col("total_freight")).alias("total_order_value"),
        "total_payment_value",
        "payment_methods",
        "max_installments",
        "review_score",
        span_days(bought, delivered).alias("delivery_days"),
        span_days(delivered, F.col("order_estimated_delivery_date")).alias(
            "delivery_vs_estimate_days"
        ),
        delivery_status().alias("delivery_status"),
    )


def _sales_profile(items: DataFrame | Dealt, enriched: DataFrame, party: str) -> DataFrame:
    """Sales of each ``party`` (seller or product), averages weighted per item.

    Items are first reduced to one row per (party, order), so that counting orders is
    counting rows, then joined with the orders; over tables in buckets neither moves
    anything. Totals per party are summed up before they are shuffled, so a hot party
    does not reach one task whole. Review and delivery facts come from the enriched
    orders, which hold them once per order.
    """
    facts = enriched.select(
        "order_id",
        "review_score",
        "order_purchase_timestamp",
        span_micros(
            F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
        ).alias("_micros"),
    )

    def sold(part: DataFrame) -> DataFrame:
        return (
            part.filter(F.col(party).isNotNull())
            .groupBy(party, "order_id")
            .agg(
                F.count(F.lit(1)).alias("_items"),
                F.sum("price").alias("_price"),
                F.count("price").alias("_priced"),
                F.sum("freight_value").alias("_freight"),
            )
            .join(facts, "order_id", "left")
        )

    times = F.col("_items").cast(_TIMES)
    return (
        dealt(items)
        .each(sold)
        .groupBy(party)
        .agg(
            F.count("order_id").alias("_orders"),
            F.sum("_items").alias("_items"),
            F.sum("_price").alias("_price"),
            F.sum("_priced").alias("_priced"),
            F.sum("_freight").alias("_freight"),
            F.sum(F.col("review_score") * F.col("_items")).alias("_review"),
            F.sum(F.when(F.col("review_score").isNotNull(), F.col("_items"))).alias("_reviewed"),
            F.sum(F.col("_micros").cast(_MICROS) * times).alias("_micros"),
            F.sum(F.when(F.col("_micros").isNotNull(), F.col("_items"))).alias("_delivered"),
            F.min("order_purchase_timestamp").alias("_first"),
            F.max("order_purchase_timestamp").alias("_last"),
        )
    )


def _mean_review() -> Column:
    return rounded_ratio(F.col("_review"), F.col("_reviewed"), 2)


def seller_performance(
    sellers: DataFrame, items: DataFrame | Dealt, enriched: DataFrame
) -> DataFrame:
    """One row per seller with sales, review, delivery and activity metrics.

    A seller without items shows one sold item and zero orders, because the
    count is over the rows of an outer join.
    """
    profile = _sales_profile(items, enriched, "seller_id")
    variety = (
        dealt(items)
        .rows()
        .filter(F.col("product_id").isNotNull())
        .select("seller_id", "product_id")
        .distinct()
        .groupBy("seller_id")
        .agg(F.count(F.lit(1)).alias("_products"))
    )
    mean_micros = F.col("_delivered").cast(_TIMES) * F.lit(MICROS_PER_DAY).cast(_MICROS)
    return (
        sellers.join(profile, "seller_id", "left")
        .join(variety, "seller_id", "left")
        .select(
            "seller_id",
            "seller_city",
            "seller_state",
            F.coalesce("_orders", F.lit(0)).alias("total_orders"),
            F.coalesce("_items", F.lit(1)).alias("total_items_sold"),
            F.coalesce("_products", F.lit(0)).alias("unique_products_sold"),
            F.col("_price").alias("total_revenue"),
            mean_money(F.col("_price"), F.col("_priced")).alias("avg_item_price"),
            F.col("_freight").alias("total_freight_collected"),
            _mean_review().alias("avg_review_score"),
            rounded_ratio(F.col("_micros"), mean_micros, 1).alias("avg_delivery_days"),
            F.col("_first").alias("first_order_date"),
            F.col("_last").alias("last_order_date"),
            span_days(F.col("_first"), F.col("_last")).alias("active_days"),
        )
    )


def product_performance(
    products: DataFrame, items: DataFrame | Dealt, enriched: DataFrame
) -> DataFrame:
    """One row per product with sales and review metrics."""
    profile = _sales_profile(items, enriched, "product_id")
    return products.join(profile, "product_id", "left").select(
        "product_id",
        "product_category",
        "product_weight_g",
        F.coalesce("_orders", F.lit(0)).alias("times_ordered"),
        F.col("_price").alias("total_revenue"),
        mean_money(F.col("_price"), F.col("_priced")).alias("avg_selling_price"),
        F.col("_freight").alias("total_freight"),
        _mean_review().alias("avg_review_score"),
        F.col("_first").alias("first_sold_date"),
        F.col("_last").alias("last_sold_date"),
    )


def customer_history(enriched: DataFrame, payments: DataFrame | Dealt) -> DataFrame:
    """One row per person with lifetime metrics.

    Payments count at row grain: an order paid in three parts weighs three times
    in the value sum, both averages and the state vote, once only in
    ``lifetime_orders``. Instead of multiplying rows, each order is joined once per
    payment type and weighted with the number of payments.
    """
    known = enriched.filter(F.col("customer_unique_id").isNotNull()).select(
        "order_id",
        "customer_unique_id",
        "customer_state",
        "order_purchase_timestamp",
        "total_order_value",
        "review_score",
    )
    weight = F.coalesce("_n", F.lit(1))  # an order without payments counts once
    value, score = F.col("total_order_value"), F.col("review_score")
    by_type = dealt(payments).each(
        lambda part: part.groupBy("order_id", "payment_type").agg(F.count(F.lit(1)).alias("_n"))
    )
    weighted = aggregate_with_modes(
        known.join(by_type, "order_id", "left"),
        "customer_unique_id",
        F.array(
            ballot("_state", F.col("customer_state"), weight),
            ballot("_method", F.col("payment_type"), weight),
        ),
        ("_state", "_method"),
        {
            "_value": value * weight.cast(_TIMES),
            "_valued": F.when(value.isNotNull(), weight),
            "_review": score * weight,
            "_reviewed": F.when(score.isNotNull(), weight),
        },
    )
    per_order = known.groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).alias("_orders"),
        F.min("order_purchase_timestamp").alias("_first"),
        F.max("order_purchase_timestamp").alias("_last"),
    )
    people = per_order.join(weighted, "customer_unique_id")
    return people.select(
        "customer_unique_id",
        F.col("_orders").alias("lifetime_orders"),
        F.col("_value").cast(DecimalType(24, 2)).alias("lifetime_value"),
        mean_money(F.col("_value"), F.col("_valued")).alias("avg_order_value"),
        _mean_review().alias("avg_review_score"),
        F.col("_first").alias("first_order_date"),
        F.col("_last").alias("last_order_date"),
        (F.col("_orders") > 1).alias("is_repeat_customer"),
        F.col("_method").alias("preferred_payment_method"),
        F.col("_state").alias("primary_state"),
    )
