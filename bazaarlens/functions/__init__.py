"""Column expressions built only from Spark's own functions."""

from bazaarlens.functions.exact import mean_money, percentage, rounded_ratio
from bazaarlens.functions.ordering import falling, rising
from bazaarlens.functions.temporal import (
    MICROS_PER_DAY,
    day_name_padded,
    month_start,
    quarter_start,
    span_days,
    span_micros,
    weekday_number,
)
from bazaarlens.functions.text import clean_code, clean_place, title_case

__all__ = [
    "MICROS_PER_DAY",
    "clean_code",
    "clean_place",
    "day_name_padded",
    "falling",
    "mean_money",
    "month_start",
    "percentage",
    "quarter_start",
    "rising",
    "rounded_ratio",
    "span_days",
    "span_micros",
    "title_case",
    "weekday_number",
]
