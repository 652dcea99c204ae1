from datetime import date, datetime
from decimal import Decimal
from fractions import Fraction
from math import floor

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bazaarlens.functions import (
    clean_code,
    clean_place,
    day_name_padded,
    mean_money,
    month_start,
    percentage,
    quarter_start,
    rounded_ratio,
    span_days,
    span_micros,
    weekday_number,
)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (" mogi-guacu ", "Mogi-Guacu"),
        ("santa barbara d'oeste", "Santa Barbara D'Oeste"),
        ("SÃO JOÃO", "São João"),
        ("4o. centenario", "4o. Centenario"),
        ("", ""),
        (None, None),
    ],
)
def test_place_names(spark, text, expected):
    assert one(spark, clean_place(F.lit(text).cast("string"))) == expected


def test_state_code(spark):
    assert one(spark, clean_code(F.lit(" sp "))) == "SP"


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_dates(spark):
    moment = ts("2018-05-20 13:30:00")  # a Sunday
    assert one(spark, month_start(moment)) == date(2018, 5, 1)
    assert one(spark, quarter_start(moment)) == date(2018, 4, 1)
    assert one(spark, weekday_number(moment)) == 0
    assert one(spark, day_name_padded(ts("2018-05-22 00:00:00"))) == "Tuesday  "
    assert one(spark, span_days(ts("2018-01-01 00:00:00"), ts("2018-01-02 12:00:00"))) == 1.5
    assert one(spark, span_micros(moment, ts("2018-05-20 13:29:59.999999"))) == -1


def test_spans_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:  # clocks there skipped the first hour of this day
        df = spark.createDataFrame([("2017-10-14 23:30:00", "2017-10-15 00:30:00")], "a string, b string")
        hour = span_micros(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz"))
        assert df.select(hour.alias("v")).first()["v"] == 3_600_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def half_away(value: Fraction, digits: int) -> Fraction:
    scaled = abs(value) * 10**digits
    rounded = Fraction(floor(scaled + Fraction(1, 2)), 10**digits)
    return -rounded if value < 0 else rounded


@settings(max_examples=1, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(-(10**15), 10**15), st.integers(1, 10**6), st.integers(0, 3)),
        min_size=40,
        max_size=40,
    )
)
def test_ratio_is_exact(spark, cases):
    cases = [*cases, (1, 8, 2), (-1, 8, 2), (5, 1000, 2), (-5, 1000, 2), (0, 7, 1)]
    df = spark.createDataFrame([(n, d) for n, d, _ in cases], "n bigint, d bigint")
    columns = [rounded_ratio(F.col("n"), F.col("d"), k).alias(f"r{k}") for k in range(4)]
    for (n, d, k), row in zip(cases, df.select(*columns).collect(), strict=True):
        assert Fraction(row[f"r{k}"]) == half_away(Fraction(n, d), k)


def test_ratio_with_scales_and_missing_values(spark):
    cents = F.lit("10.05").cast("decimal(10,2)")
    assert one(spark, rounded_ratio(cents, F.lit(2), 2, numerator_scale=2)) == Decimal("5.03")
    assert one(spark, rounded_ratio(cents, F.lit(0), 2, numerator_scale=2)) is None
    assert one(spark, rounded_ratio(F.lit(None).cast("int"), F.lit(2), 2)) is None
    assert one(spark, percentage(F.lit(1), F.lit(8))) == Decimal("12.5")
    assert one(spark, percentage(F.lit(-1), F.lit(3))) == Decimal("-33.3")
    assert one(spark, mean_money(F.lit("10.00").cast("decimal(20,2)"), F.lit(3))) == Decimal(
        "3.3333333333333333"
    )


def test_everything_is_built_in(spark):
    df = spark.createDataFrame([(datetime(2018, 1, 1), "a b")], "t timestamp_ntz, s string")
    plan = df.select(clean_place("s"), weekday_number(F.col("t")))._jdf.queryExecution().toString()
    assert "Python" not in plan
