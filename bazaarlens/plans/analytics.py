"""Eighteen analytical reports over the marts and lower layers.

Reports whose rows are months, days, weekdays or states use plain windows: the
aggregate below them has at most one row per calendar unit or state. Anything
that grows with orders, persons or sellers avoids windows without partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from bazaarlens.functions import (
    falling,
    percentage,
    quarter_start,
    rising,
    rounded_ratio,
    span_days,
    weekday_number,
)
from bazaarlens.operators.calendar import days_between
from bazaarlens.operators.months import ActiveMonths, active_months
from bazaarlens.operators.pairs import top_shared_pairs
from bazaarlens.plans.marts import delivery_micros, mean_days, mean_of, share_where
from bazaarlens.sources.buckets import Dealt, dealt

# Literals of the reports, overridable through parameters.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
COHORT_OFFSETS = (0, 1, 2, 3, 6, 12)
ROLLUP_STATES = ("SP", "RJ", "MG")
ROLLUP_CATEGORIES = ("bed_bath_table", "health_beauty", "sports_leisure")
CUBE_STATES = ("SP", "RJ")
CUBE_CATEGORIES = ("bed_bath_table", "health_beauty")
ALL_STATES, ALL_CATEGORIES, ALL = "** ALL STATES **", "** ALL CATEGORIES **", "** ALL **"

_RATIO = DecimalType(23, 13)  # freight/price quotient, thirteen exact-rounded decimals


def mom_growth(months: DataFrame) -> DataFrame:
    """Value per month with the previous month and the growth in percent.

    Growth is NULL unless the previous value is positive.
    """
    previous = F.lag("gmv").over(Window.orderBy(rising("month_start")))
    growth = percentage(F.col("gmv") - F.col("prev_month_gmv"), F.col("prev_month_gmv"), scale=2)
    return (
        months.select("month_start", "gmv", "total_orders", previous.alias("prev_month_gmv"))
        .withColumn("mom_growth_pct", F.when(F.col("prev_month_gmv") > 0, growth))
        .orderBy(rising("month_start"))
    )


def cumulative_gmv(months: DataFrame) -> DataFrame:
    """Running totals of value and orders by month."""
    so_far = Window.orderBy(rising("month_start"))
    return months.select(
        "month_start",
        "gmv",
        F.sum("gmv").over(so_far).alias("cumulative_gmv"),
        F.sum("total_orders").over(so_far).alias("cumulative_orders"),
    ).orderBy(rising("month_start"))


def top_categories(categories: DataFrame, *, limit: int = 10) -> DataFrame:
    """The best-selling categories with their rank.

    The cut is made first: rows outside the top cannot change a rank inside it.
    """
    best = categories.orderBy(falling("total_revenue"), rising("product_category")).limit(limit)
    return best.select(
        F.rank().over(Window.orderBy(falling("total_revenue"))).alias("revenue_rank"),
        "product_category",
        "total_revenue",
        "total_orders",
        "avg_price",
        "avg_review_score",
    ).orderBy("revenue_rank", "product_category")


def state_pareto(states: DataFrame) -> DataFrame:
    """Each state's share of revenue and the cumulative share, largest first.

    States with equal revenue share one cumulative value.
    """
    revenue = F.col("total_revenue")
    whole = F.sum(revenue).over(Window.partitionBy())
    so_far = F.sum(revenue).over(Window.orderBy(falling("total_revenue")))
    return (
        states.select(
            "customer_state", "total_revenue", whole.alias("_whole"), so_far.alias("_so_far")
        )
        .select(
            "customer_state",
            "total_revenue",
            percentage(revenue, F.col("_whole"), scale=2).alias("pct_of_total"),
            percentage(F.col("_so_far"), F.col("_whole"), scale=2).alias("cumulative_pct"),
        )
        .orderBy(falling("total_revenue"))
    )


def top_sellers_per_state(scorecard: DataFrame, *, places: int = 3) -> DataFrame:
    """The best sellers of each state by revenue; ties go by seller id.

    Each task keeps its best ``places`` per state before the shuffle.
    """
    by_revenue = Window.partitionBy("seller_state").orderBy(
        falling("total_revenue"), rising("seller_id")
    )
    return (
        scorecard.select(
            "seller_state",
            "seller_id",
            "seller_city",
            "total_revenue",
            "total_orders",
            "avg_review_score",
            F.row_number().over(by_revenue).alias("rank_in_state"),
        )
        .filter(F.col("rank_in_state") <= places)
        .orderBy(rising("seller_state"), "rank_in_state")
    )


def repeat_order_gap(enriched: DataFrame, history: DataFrame, *, limit: int = 30) -> DataFrame:
    """First orders of repeat customers with the neighbouring orders and the gap.

    Ordered by person, time and order id. Each repeat customer has an order, so
    the first ``limit + 1`` persons and then their first ``limit + 1`` orders
    hold the result and every neighbour in it; no person's orders are gathered.
    """
    person, bought = "customer_unique_id", F.col("order_purchase_timestamp")
    repeat = history.filter(F.col("is_repeat_customer") & F.col(person).isNotNull())
    first_people = repeat.select(person).orderBy(rising(person)).limit(limit + 1)
    order = [rising(person), rising(bought), rising("order_id")]
    # At most limit + 1 rows are broadcast, and at most that many reach the window.
    head = (
        enriched.select(person, "order_id", "order_purchase_timestamp")
        .join(F.broadcast(first_people), person, "left_semi")
        .orderBy(*order)
        .limit(limit + 1)
    )
    of_person = Window.partitionBy(person).orderBy(rising(bought), rising("order_id"))
    previous = F.lag(bought).over(of_person)
    return (
        head.select(
            person,
            "order_id",
            "order_purchase_timestamp",
            previous.alias("previous_order_date"),
            F.lead(bought).over(of_person).alias("next_order_date"),
        )
        .withColumn("days_since_last_order", span_days(F.col("previous_order_date"), bought))
        .orderBy(*order)
        .limit(limit)
    )


def payment_trends(payments: DataFrame | Dealt, orders: DataFrame) -> DataFrame:
    """Share of each payment type per quarter."""
    dated = orders.select(
        "order_id", quarter_start(F.col("order_purchase_timestamp")).alias("quarter")
    )
    return (
        dealt(payments)
        .each(lambda part: part.select("order_id", "payment_type").join(dated, "order_id"))
        .groupBy("quarter")
        .agg(
            F.count(F.lit(1)).alias("total_payments"),
            *[
                share_where(F.col("payment_type") == kind).alias(f"{kind}_pct")
                for kind in PAYMENT_TYPES
            ],
        )
        .orderBy(rising("quarter"))
    )


def delivery_by_weekday(enriched: DataFrame) -> DataFrame:
    """Delivered orders, delivery days and late share per weekday (Sunday is 0)."""
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    return (
        enriched.filter(F.col("order_status") == "delivered")
        .groupBy(weekday_number(F.col("order_purchase_timestamp")).alias("dow_num"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            mean_days(delivery_micros()).alias("avg_delivery_days"),
            share_where(F.col("delivery_status") == "late").alias("late_pct"),
        )
        .select(
            F.get(names, F.col("dow_num")).alias("day_of_week"),
            "dow_num",
            "total_orders",
            "avg_delivery_days",
            "late_pct",
        )
        .orderBy(rising("dow_num"))
    )


def _active_months(enriched: DataFrame) -> ActiveMonths:
    """The months with orders of each person, one bit each."""
    known = enriched.filter(F.col("customer_unique_id").isNotNull())
    return active_months(known, "customer_unique_id", "order_purchase_timestamp")


def cohort_retention(enriched: DataFrame) -> DataFrame:
    """Persons per first-purchase month who order again some months later."""
    active = _active_months(enriched)
    again = [active.has(F.col("_first") + n).alias(f"_after_{n}") for n in COHORT_OFFSETS]
    return (
        active.rows.withColumn("_first", active.first())
        .select("_first", *again)
        .groupBy(active.start(F.col("_first")).alias("cohort_month"))
        .agg(*[F.count_if(f"_after_{n}").alias(f"month_{n}") for n in COHORT_OFFSETS])
        .orderBy(rising("cohort_month"))
    )


def _category_cells(
    items: DataFrame | Dealt,
    products: DataFrame,
    enriched: DataFrame,
    states: Sequence[str],
    categories: Sequence[str],
) -> DataFrame:
    """Orders and revenue of every state, category and total, with flags of the totals.

    An order becomes one row with a bit for each category in it and its sales by category:
    orders of any group are then counted from the bits, without a copy of its lines for
    each. An order has one state, so orders of all states add up.
    """
    kept = products.filter(F.col("product_category").isin(*categories)).select(
        "product_id", "product_category"
    )
    placed = enriched.filter(F.col("customer_state").isin(*states)).select(
        "order_id", "customer_state"
    )
    category = F.col("product_category")
    bit = F.coalesce(*[F.when(category == c, F.lit(1 << i)) for i, c in enumerate(categories)])

    def per_order(part: DataFrame) -> DataFrame:
        # by order first: over tables in buckets that join moves nothing
        return (
            part.select("order_id", "product_id", "price")
            .join(placed, "order_id")
            .join(kept, "product_id")
            .groupBy("order_id", "customer_state")
            .agg(
                F.bit_or(bit).alias("_held"),
                F.sum("price").alias("_all"),
                *[
                    F.sum(F.when(category == c, F.col("price"))).alias(f"_of{i}")
                    for i, c in enumerate(categories)
                ],
            )
        )

    def cell(name: str | None, orders: Column, revenue: str) -> Column:
        return F.struct(
            F.lit(name).cast("string").alias("product_category"),
            F.lit(int(name is None)).alias("is_category_total"),
            orders.alias("_orders"),
            F.sum(revenue).alias("_revenue"),
        )

    holds = [F.col("_held").bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(categories))]
    per_state = (
        dealt(items)
        .each(per_order)
        .groupBy("customer_state")
        .agg(
            F.array(
                *[cell(c, F.count_if(holds[i]), f"_of{i}") for i, c in enumerate(categories)],
                cell(None, F.count(F.lit(1)), "_all"),
            ).alias("_cells")
        )
    )
    # from here on a row per state and category
    both = [
        F.struct(F.col("customer_state").alias("state"), F.lit(0).alias("is_state_total")),
        F.struct(F.lit(None).cast("string").alias("state"), F.lit(1).alias("is_state_total")),
    ]
    return (
        per_state.select(F.explode(F.array(*both)).alias("_at"), "_cells")
        .select("_at.*", F.inline("_cells"))
        .filter(F.col("_orders") > 0)
        .groupBy("state", "is_state_total", "product_category", "is_category_total")
        .agg(
            F.sum("_orders").alias("orders"),
            F.sum("_revenue").cast(DecimalType(20, 2)).alias("revenue"),
        )
    )


def rollup_state_category(
    items: DataFrame | Dealt,
    products: DataFrame,
    enriched: DataFrame,
    *,
    states: Sequence[str] = ROLLUP_STATES,
    categories: Sequence[str] = ROLLUP_CATEGORIES,
) -> DataFrame:
    """Orders and revenue per state and category with subtotals.

    ``is_state_total`` marks the grand total only; the total of one state has
    ``is_category_total`` set.
    """
    cells = _category_cells(items, products, enriched, states, categories)
    return (
        cells.filter((F.col("is_state_total") == 0) | (F.col("is_category_total") == 1))
        .select(
            F.coalesce("state", F.lit(ALL_STATES)).alias("state"),
            F.coalesce("product_category", F.lit(ALL_CATEGORIES)).alias("category"),
            "orders",
            "revenue",
            "is_state_total",
            "is_category_total",
        )
        .orderBy("is_state_total", rising("state"), "is_category_total", falling("revenue"))
    )


def cube_state_category(
    items: DataFrame | Dealt,
    products: DataFrame,
    enriched: DataFrame,
    *,
    states: Sequence[str] = CUBE_STATES,
    categories: Sequence[str] = CUBE_CATEGORIES,
) -> DataFrame:
    """Orders and revenue for every combination of state and category totals."""
    cells = _category_cells(items, products, enriched, states, categories)
    return cells.select(
        F.coalesce("state", F.lit(ALL)).alias("state"),
        F.coalesce("product_category", F.lit(ALL)).alias("category"),
        "orders",
        "revenue",
    ).orderBy(rising("state"), rising("category"))


def sellers_above_state_average(
    scorecard: DataFrame, *, factor: int = 2, limit: int = 15
) -> DataFrame:
    """Sellers with more than ``factor`` times their state's mean revenue.

    Compared as revenue x sellers > factor x total, so no rounded mean decides.
    """
    states = scorecard.groupBy("seller_state").agg(
        F.sum("total_revenue").alias("_total"),
        F.count("total_revenue").cast(DecimalType(13, 0)).alias("_sellers"),
    )
    revenue = F.col("total_revenue").cast(DecimalType(22, 2))
    total = F.col("_total").cast(DecimalType(24, 2))
    scaled = revenue * F.col("_sellers")
    return (
        scorecard.join(states, "seller_state")
        .filter(scaled > total * F.lit(factor))
        .select(
            "seller_id",
            "seller_state",
            "seller_city",
            "total_orders",
            revenue.alias("seller_revenue"),
            rounded_ratio(total, F.col("_sellers"), 2, numerator_scale=2).alias(
                "state_avg_revenue"
            ),
            rounded_ratio(scaled, total, 1, numerator_scale=2, denominator_scale=2).alias(
                "times_above_avg"
            ),
        )
        .orderBy(falling("times_above_avg"), rising("seller_id"))
        .limit(limit)
    )


def _delivered_days(enriched: DataFrame, revenue: str) -> DataFrame:
    return (
        enriched.filter(F.col("order_status") == "delivered")
        .groupBy("order_date")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_order_value").alias(revenue))
    )


def moving_average(enriched: DataFrame, *, rows: int = 7) -> DataFrame:
    """Daily orders and revenue with averages over the last ``rows`` days present.

    The window counts rows, so days without orders are skipped, not zero.
    """
    recent = Window.orderBy(rising("order_date")).rowsBetween(1 - rows, 0)

    def average(name: str, digits: int, scale: int) -> Column:
        amount = F.col(name)
        return rounded_ratio(
            F.sum(amount).over(recent), F.count(amount).over(recent), digits, numerator_scale=scale
        )

    return (
        _delivered_days(enriched, "daily_revenue")
        .select(
            "order_date",
            "orders",
            "daily_revenue",
            average("orders", 1, 0).alias(f"orders_{rows}day_avg"),
            average("daily_revenue", 2, 2).alias(f"revenue_{rows}day_avg"),
        )
        .orderBy(rising("order_date"))
    )


def calendar_fill(enriched: DataFrame) -> DataFrame:
    """Every day from the first to the last order, zero where nothing was delivered."""
    days = days_between(enriched, "order_date", "cal_date")
    actual = _delivered_days(enriched, "revenue")
    return (
        days.join(actual, F.col("cal_date") == F.col("order_date"), "left")
        .select(
            "cal_date",
            F.coalesce("orders", F.lit(0)).alias("orders"),
            F.coalesce("revenue", F.lit(0)).alias("revenue"),
            weekday_number(F.col("cal_date")).alias("day_of_week"),
        )
        .orderBy(rising("cal_date"))
    )


def reviews_by_delivery(enriched: DataFrame, *, more_than: int = 100) -> DataFrame:
    """Review scores of delivered, reviewed orders by delivery status."""
    score = F.col("review_score")
    return (
        enriched.filter((F.col("order_status") == "delivered") & score.isNotNull())
        .groupBy("delivery_status")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            mean_of(score).alias("avg_review"),
            F.count_if(score == 5).alias("five_star"),
            F.count_if(score == 1).alias("one_star"),
            share_where(score <= 2).alias("low_review_pct"),
            share_where(score >= 4).alias("high_review_pct"),
        )
        .filter(F.col("total_orders") > more_than)
        .orderBy(falling("avg_review"))
    )


def shared_customer_pairs(
    items: DataFrame | Dealt, enriched: DataFrame, *, at_least: int = 5, limit: int = 15
) -> DataFrame:
    """Seller pairs with the most common customers."""
    people = enriched.select("order_id", "customer_unique_id")
    links = (
        dealt(items)
        .each(lambda part: part.select("order_id", "seller_id").join(people, "order_id"))
        .select("seller_id", "customer_unique_id")
        .distinct()
    )
    pairs = top_shared_pairs(
        links, "seller_id", "customer_unique_id", at_least=at_least, limit=limit
    )
    return pairs.select(
        F.col("first").alias("seller_a"),
        F.col("second").alias("seller_b"),
        F.col("shared").alias("shared_customers"),
    )


def new_vs_returning(enriched: DataFrame) -> DataFrame:
    """Persons ordering per month, split into first-time and returning ones."""
    active = _active_months(enriched)
    month, first = F.col("_month"), F.col("_first")
    return (
        active.rows.select(active.first().alias("_first"), F.explode(active.all()).alias("_month"))
        .groupBy(active.start(month).alias("month"))
        .agg(
            F.count(F.lit(1)).alias("total_customers"),
            F.count_if(first == month).alias("new_customers"),
            F.count_if(first < month).alias("returning_customers"),
        )
        .select(
            "month",
            "total_customers",
            "new_customers",
            "returning_customers",
            percentage(F.col("new_customers"), F.col("total_customers")).alias("new_pct"),
            percentage(F.col("returning_customers"), F.col("total_customers")).alias(
                "returning_pct"
            ),
        )
        .orderBy(rising("month"))
    )


def freight_ratio(
    items: DataFrame, products: DataFrame, *, min_items: int = 20, above: str = "0.5"
) -> DataFrame:
    """Categories whose mean freight-to-price ratio exceeds ``above``.

    Items with price zero are left out of the ratio but still counted.

    Items are first totalled per product, so the join moves one row per product.
    """
    price, freight = F.col("price"), F.col("freight_value")
    ratio = (freight / F.nullif(price, F.lit(0).cast("decimal(10,2)"))).cast(_RATIO)
    per_product = items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("_items"),
        F.sum(price).alias("_price"),
        F.count(price).alias("_priced"),
        F.sum(freight).alias("_freight"),
        F.count(freight).alias("_freighted"),
        F.sum(ratio).alias("_ratio"),
        F.count(ratio).alias("_ratios"),
    )
    weight = F.col("product_weight_g")
    weighed = F.when(weight.isNotNull(), F.col("_items"))
    totals = (
        per_product.join(
            products.select("product_id", "product_category", "product_weight_g"), "product_id"
        )
        .groupBy("product_category")
        .agg(
            *[
                F.sum(name).alias(name)
                for name in (
                    "_items",
                    "_price",
                    "_priced",
                    "_freight",
                    "_freighted",
                    "_ratio",
                    "_ratios",
                )
            ],
            F.sum(weight * F.col("_items").cast(DecimalType(13, 0))).alias("_weight"),
            F.sum(weighed).alias("_weighed"),
        )
    )
    mean_ratio_above = F.col("_ratio") > F.lit(above).cast("decimal(10,4)") * F.col("_ratios").cast(
        DecimalType(13, 0)
    )
    return (
        totals.filter((F.col("_items") >= min_items) & mean_ratio_above)
        .select(
            "product_category",
            F.col("_items").alias("items_sold"),
            rounded_ratio(F.col("_price"), F.col("_priced"), 2, numerator_scale=2).alias(
                "avg_price"
            ),
            rounded_ratio(F.col("_freight"), F.col("_freighted"), 2, numerator_scale=2).alias(
                "avg_freight"
            ),
            (
                rounded_ratio(
                    F.col("_ratio"), F.col("_ratios"), 3, numerator_scale=_RATIO.scale
                )
                * F.lit(100)
            )
            .cast(DecimalType(20, 1))
            .alias("freight_pct_of_price"),
            rounded_ratio(F.col("_weight"), F.col("_weighed"), 0, numerator_scale=4).alias(
                "avg_weight_g"
            ),
        )
        .orderBy(falling("freight_pct_of_price"))
    )
