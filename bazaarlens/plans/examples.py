"""Four short lookups over the staging and intermediate layers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions import falling, rising
from bazaarlens.plans.marts import mean_of

# Literals of the lookups, overridable through parameters.
STATUS = "shipped"
RANGE_FROM, RANGE_TO = "2018-01-01", "2018-03-31"
ITEMS_SINCE, ITEMS_LIMIT = "2018-06-01", 100
VALUE_FROM, VALUE_TO = "2018-01-01", "2018-06-30"


def _moment(text: str | date | datetime) -> Column:
    return F.lit(str(text)).cast("timestamp_ntz")


def count_by_status(orders: DataFrame, *, status: str = STATUS) -> DataFrame:
    """Number of orders in one status."""
    return orders.filter(F.col("order_status") == status).agg(F.count(F.lit(1)).alias("orders"))


def orders_in_range(
    orders: DataFrame, *, start: str = RANGE_FROM, end: str = RANGE_TO
) -> DataFrame:
    """Orders bought from ``start`` up to midnight at the beginning of ``end``."""
    return orders.filter(
        F.col("order_purchase_timestamp").between(_moment(start), _moment(end))
    ).select("order_id", "customer_id", "order_purchase_timestamp")


def delivered_items_since(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    *,
    since: str = ITEMS_SINCE,
    limit: int = ITEMS_LIMIT,
) -> DataFrame:
    """The first items, by order and item number, of orders delivered since a date."""
    recent = orders.filter(
        (F.col("order_status") == "delivered")
        & (F.col("order_purchase_timestamp") >= _moment(since))
    ).select("order_id", "order_status")
    first = (
        recent.join(items.select("order_id", "order_item_id", "product_id", "price"), "order_id")
        .join(products.select("product_id", "product_category"), "product_id")
        .orderBy(rising("order_id"), rising("order_item_id"))
        .limit(limit)
    )
    return first.select("order_id", "order_status", "price", "product_category")


def state_on_time_value(
    enriched: DataFrame, *, start: str = VALUE_FROM, end: str = VALUE_TO
) -> DataFrame:
    """Orders delivered on time and their mean value per state in a date range.

    The months of the range are named too: stored orders lie in monthly folders.
    """
    month = F.col("order_year") * 12 + F.col("order_month")

    def number(text: str) -> Column:
        day = F.lit(text).cast("date")
        return F.year(day) * 12 + F.month(day)

    return (
        enriched.filter(month.between(number(start), number(end)))
        .filter(
            F.col("order_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
            & (F.col("delivery_status") == "on_time")
        )
        .groupBy("customer_state")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            mean_of(F.col("total_order_value"), scale=2).alias("avg_value"),
        )
        .orderBy(falling("orders"), rising("customer_state"))
    )
