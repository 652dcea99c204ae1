"""Type-2 history of seller activity.

A seller is active in a month with sold items and inactive in every other month
that has orders at all. A new row starts where the status changes.

The history is derived from the active months alone: an inactive stretch begins
in the month after an active one and ends at the next. Sellers are never
multiplied by months.

A month that follows all others is merged into a stored history: where a seller's status
differs from that of the open range, the range is closed and the next one opened. Closed
ranges and keys never change.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions import falling, month_start, rising
from bazaarlens.operators.placement import row_numbers
from bazaarlens.operators.scratch import stored
from bazaarlens.sources.buckets import Dealt, dealt

# Fixed value: end of validity of a current row.
OPEN_END = "9999-12-31"
HISTORY = (
    "seller_id", "seller_status", "valid_from", "valid_to", "is_current", "orders_at_change", "scd_id",
)


def order_months(orders: DataFrame) -> DataFrame:
    """The months with orders, numbered in order; months without any do not appear.

    At most one row per calendar month, so a plain window and a broadcast are safe.
    """
    months = orders.select(month_start(F.col("order_purchase_timestamp")).alias("month_start"))
    months = months.distinct()
    return months.select(
        "month_start",
        F.row_number().over(Window.orderBy(rising("month_start"))).alias("month_number"),
        F.row_number().over(Window.orderBy(falling("month_start"))).alias("months_left"),
    )


def seller_months(items: DataFrame | Dealt, orders: DataFrame) -> DataFrame:
    """Sold items per seller and month (items, not orders)."""
    dated = orders.select(
        "order_id", month_start(F.col("order_purchase_timestamp")).alias("month_start")
    )
    return (
        dealt(items)
        .each(lambda part: part.select("order_id", "seller_id").join(dated, "order_id"))
        .groupBy("seller_id", "month_start")
        .agg(F.count(F.lit(1)).alias("orders_in_month"))
    )


def change_points(
    sellers: DataFrame, items: DataFrame | Dealt, orders: DataFrame
) -> DataFrame:
    """The months in which a seller's status starts, in the first month or by change."""
    months = order_months(orders)
    active = seller_months(items, orders).join(F.broadcast(months), "month_start")
    # At most one row per seller and month: a bounded window.
    by_month = Window.partitionBy("seller_id").orderBy("month_number")
    steps = (
        sellers.select("seller_id")
        .join(active.drop("month_start"), "seller_id", "left")
        .withColumn("_previous", F.lag("month_number").over(by_month))
        .withColumn("_next", F.lead("month_number").over(by_month))
    )
    number, previous = F.col("month_number"), F.col("_previous")
    starts = F.coalesce(previous, F.lit(0)) + 1 < number

    def begin(month, status, amount):
        return F.struct(
            month.cast("int").alias("month_number"),
            F.lit(status).alias("seller_status"),
            amount.cast("bigint").alias("orders_in_month"),
        )

    none = F.lit(0)
    never = F.when(number.isNull(), begin(F.lit(1), "inactive", none))
    idle_before = F.when(starts & previous.isNull(), begin(F.lit(1), "inactive", none))
    begins = F.when(
        number.isNotNull() & (starts | previous.isNull()),
        begin(number, "active", F.col("orders_in_month")),
    )
    idle_after = F.when(
        (F.col("months_left") > 1) & (F.coalesce(F.col("_next"), F.lit(0)) != number + 1),
        begin(number + 1, "inactive", none),
    )
    points = steps.select(
        "seller_id",
        F.inline(F.array_compact(F.array(never, idle_before, begins, idle_after))),
    )
    return points.join(
        F.broadcast(months.select("month_number", F.col("month_start").alias("valid_from"))),
        "month_number",
    ).select("seller_id", "month_number", "valid_from", "seller_status", "orders_in_month")


def seller_status_history(
    sellers: DataFrame, items: DataFrame | Dealt, orders: DataFrame
) -> DataFrame:
    """Validity ranges with a surrogate key numbered by seller and start."""
    ranges = validity_ranges(change_points(sellers, items, orders))
    return row_numbers(ranges, [rising("seller_id"), rising("valid_from")], "scd_id")


def validity_ranges(points: DataFrame) -> DataFrame:
    """Ranges from each change to the day before the next one; the last is open."""
    by_start = Window.partitionBy("seller_id").orderBy("month_number")
    following = F.lead("valid_from").over(by_start)
    return points.select(
        "seller_id",
        "seller_status",
        "valid_from",
        F.coalesce(F.date_sub(following, 1), F.lit(OPEN_END).cast("date")).alias("valid_to"),
        following.isNull().alias("is_current"),
        F.col("orders_in_month").alias("orders_at_change"),
    )


def span_of_months(orders: DataFrame) -> tuple[date, date] | None:
    """The first and the last month with orders."""
    month = month_start(F.col("order_purchase_timestamp"))
    first, last = orders.agg(F.min(month), F.max(month)).first()
    return None if first is None else (first, last)


def merged_month(
    open_ranges: DataFrame,
    sellers: DataFrame,
    items: DataFrame | Dealt,
    orders: DataFrame,
    *,
    month: date,
    first_month: date,
    last_key: int,
) -> DataFrame:
    """The ranges that are open, or were closed, after ``month`` is merged.

    ``open_ranges``: the current row of each seller; ``month``: later than all months of
    the history, which begins in ``first_month``; ``last_key``: the greatest key given so
    far. Only orders of the month are read. A seller without history was inactive
    from the first month on; one that is no longer listed keeps its open range.
    Returns the columns of the history: unchanged open ranges, closed ones with the day
    before as their end, and new open ones with the next keys.
    """
    start = F.lit(month)
    bought = F.col("order_purchase_timestamp")
    this_month = orders.filter(
        (bought >= start.cast("timestamp_ntz"))
        & (bought < F.add_months(start, 1).cast("timestamp_ntz"))
    )
    active = seller_months(items, this_month).select("seller_id", "orders_in_month")
    known = open_ranges.withColumn("_known", F.lit(True))
    listed = sellers.select("seller_id", F.lit(True).alias("_listed"))
    rows = known.join(listed, "seller_id", "full").join(active, "seller_id", "left")

    sold = F.col("orders_in_month")
    status = F.when(sold.isNotNull(), "active").otherwise("inactive")
    open_end = F.lit(OPEN_END).cast("date")

    def row(key, state, begin, end, current, amount):
        return F.struct(
            key.cast("bigint").alias("scd_id"),
            state.alias("seller_status"),
            begin.alias("valid_from"),
            end.alias("valid_to"),
            F.lit(current).alias("is_current"),
            amount.cast("bigint").alias("orders_at_change"),
        )

    none, new = F.lit(0), F.lit(None)
    was = [F.col(c) for c in ("scd_id", "seller_status", "valid_from")]
    amount = F.col("orders_at_change")
    seen, first = F.col("_known").isNotNull(), F.lit(first_month == month)
    differs = seen & F.col("_listed").isNotNull() & (F.col("seller_status") != status)
    since_first = F.lit(first_month)
    ranges = F.array(
        F.when(seen & ~differs, row(*was, open_end, True, amount)),
        F.when(differs, row(*was, F.date_sub(start, 1), False, amount)),
        F.when(differs | (~seen & (first | sold.isNotNull())),
               row(new, status, start, open_end, True, F.coalesce(sold, none))),
        F.when(~seen & ~first & sold.isNotNull(),
               row(new, F.lit("inactive"), since_first, F.date_sub(start, 1), False, none)),
        F.when(~seen & ~first & sold.isNull(),
               row(new, F.lit("inactive"), since_first, open_end, True, none)),
    )
    merged = stored(rows.select("seller_id", F.inline(F.array_compact(ranges))))
    named = row_numbers(
        merged.filter(F.col("scd_id").isNull()), [rising("seller_id"), rising("valid_from")], "_nth"
    )
    columns = [c for c in HISTORY if c != "scd_id"]
    added = named.select(*columns, (F.col("_nth") + last_key).alias("scd_id"))
    return merged.filter(F.col("scd_id").isNotNull()).select(*HISTORY).unionByName(added)
