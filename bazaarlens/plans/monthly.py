"""Monthly states of the order marts: what one month's orders add to each state's totals.

States of different months merge: sums and counts by adding up, sets of persons by uniting
bitmaps. So a mart over orders needs the states of all months, but only the orders of
months that have changed. Persons have lasting numbers, to which new persons are added.
"""

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
from bazaarlens.operators.bitmaps import numbered_lists, word_and_bit

_MICROS = DecimalType(18, 0)
_TIMES = DecimalType(13, 0)
_MONEY = DecimalType(31, 2)
MONTH = ("order_year", "order_month")
PERSON = "customer_unique_id"
#: What states are made of, apart from the month.
FACTS = (
    "order_id", PERSON, "customer_state", "order_status", "order_purchase_timestamp",
    "order_delivered_customer_date", "total_order_value", "total_freight", "review_score",
    "delivery_status",
)
#: Columns of the stored states.
STATES = {
    "sums": "customer_state string, orders bigint, value decimal(31,2), valued bigint, "
    "freight decimal(30,2), review bigint, reviewed bigint, micros decimal(28,0), "
    "delivered bigint, late bigint, low bigint, order_year int, order_month int",
    "words": "customer_state string, word bigint, bits bigint, order_year int, order_month int",
}
#: Names of the summed columns.
SUMS = (
    "orders", "value", "valued", "freight", "review", "reviewed", "micros", "delivered", "late", "low",
)


def _delivered(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("order_status") == "delivered")


def month_sums(enriched: DataFrame) -> DataFrame:
    """Counts and sums of delivered orders per month and customer state."""
    value, review = F.col("total_order_value"), F.col("review_score")
    micros = span_micros(
        F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    ).cast(_MICROS)
    return (
        _delivered(enriched)
        .groupBy(*MONTH, "customer_state")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(value).alias("value"),
            F.count(value).alias("valued"),
            F.sum("total_freight").alias("freight"),
            F.sum(review).alias("review"),
            F.count(review).alias("reviewed"),
            F.sum(micros).alias("micros"),
            F.count(micros).alias("delivered"),
            F.count_if(F.col("delivery_status") == "late").alias("late"),
            F.count_if(review <= 2).alias("low"),
        )
    )


def month_people(enriched: DataFrame) -> DataFrame:
    """The different persons of delivered orders per month and customer state."""
    known = _delivered(enriched).filter(F.col(PERSON).isNotNull())
    return known.select(*MONTH, "customer_state", PERSON).distinct()


def month_words(people: DataFrame, numbers: DataFrame) -> DataFrame:
    """Bitmaps of persons, one row per word; ``numbers``: id and ``_number`` of each."""
    word, bit = word_and_bit(F.col("_number"))
    return (
        people.join(numbers.withColumnRenamed("id", PERSON), PERSON)
        .groupBy(*MONTH, "customer_state", word.alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )


def merged(sums: DataFrame, words: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """States added up per ``keys``, with the number of different persons."""
    added = sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])
    people = (
        words.groupBy(*keys, "word")
        .agg(F.bit_or("bits").alias("bits"))
        .groupBy(*[F.col(key).alias(f"_{key}") for key in keys])
        .agg(F.sum(F.bit_count("bits")).alias("people"))
    )
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return added.join(people, same, "left")


def _measures(value: str, *more: Column) -> list[Column]:
    per_day = F.col("delivered").cast(_TIMES) * F.lit(MICROS_PER_DAY).cast(_MICROS)
    return [
        F.col("orders").alias("total_orders"),
        F.coalesce("people", F.lit(0)).alias("unique_customers"),
        F.col("value").cast(_MONEY).alias(value),
        rounded_ratio(F.col("value"), F.col("valued"), 2, numerator_scale=2).alias("avg_order_value"),
        *more,
        rounded_ratio(F.col("review"), F.col("reviewed"), 2).alias("avg_review_score"),
        rounded_ratio(F.col("micros"), per_day, 1).alias("avg_delivery_days"),
        percentage(F.col("late"), F.col("orders")).alias("late_delivery_pct"),
    ]


def monthly_revenue(sums: DataFrame, words: DataFrame) -> DataFrame:
    """Delivered orders per purchase month: volume, value, freight, quality."""
    month = F.make_date("order_year", "order_month", F.lit(1)).alias("month_start")
    freight = F.col("freight").cast(DecimalType(30, 2)).alias("total_freight_revenue")
    return merged(sums, words, MONTH).select(
        *MONTH, month, *_measures("gmv", freight)
    ).orderBy(rising("month_start"))


def state_performance(sums: DataFrame, words: DataFrame) -> DataFrame:
    """Delivered orders per customer state.

    Low reviews are a share of all delivered orders, reviewed or not.
    """
    low = percentage(F.col("low"), F.col("orders")).alias("low_review_pct")
    return (
        merged(sums, words, ("customer_state",))
        .select("customer_state", *_measures("total_revenue"), low)
        .orderBy(falling("total_revenue"))
    )


def states_of(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sums and persons of all months of a table that has no stored states."""
    people = month_people(enriched)
    (numbers,) = numbered_lists(people.select(F.col(PERSON).alias("id")).distinct())
    return month_sums(enriched), month_words(people, numbers)
