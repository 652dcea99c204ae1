"""Exact division and rounding.

Averages and percentages of money are rounded once, half away from zero, on
whole numbers. Doubles would make the last digit depend on the order in which
partial sums arrive; a rounded decimal average would be rounded twice.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

_WHOLE = DecimalType(38, 0)


def _whole(number: Column, scale: int) -> Column:
    """``number`` (at most ``scale`` decimals) times 10**scale, as a whole number."""
    if scale == 0:
        return number.cast(_WHOLE)
    narrowed = number.cast(DecimalType(38 - scale // 2, scale))
    return (narrowed * F.lit(Decimal(10) ** scale)).cast(_WHOLE)


def rounded_ratio(
    numerator: Column,
    denominator: Column,
    digits: int,
    *,
    numerator_scale: int = 0,
    denominator_scale: int = 0,
) -> Column:
    """``numerator / denominator`` rounded half away from zero to ``digits`` places.

    The scales say how many decimals the inputs may carry. The result is NULL
    when either input is NULL or the denominator is zero.
    """
    n = _whole(numerator, numerator_scale)
    d = F.nullif(_whole(denominator, denominator_scale), F.lit(0).cast(_WHOLE))
    shift = digits + denominator_scale - numerator_scale
    factor = F.lit(Decimal(10) ** abs(shift))
    negative = (n < 0) != (d < 0)
    if shift > 0:
        top, bottom = (F.abs(n) * factor).cast(_WHOLE), F.abs(d)
    elif shift < 0:
        top, bottom = F.abs(n), (F.abs(d) * factor).cast(_WHOLE)
    else:
        top, bottom = F.abs(n), F.abs(d)
    double_bottom = (bottom * F.lit(Decimal(2))).cast(_WHOLE)
    double_top = (top * F.lit(Decimal(2))).cast(_WHOLE)
    units = F.call_function("div", (double_top + bottom).cast(_WHOLE), double_bottom)
    signed = F.when(negative, -units).otherwise(units).cast(DecimalType(20, 0))
    if digits == 0:
        return signed
    return (signed * F.lit(Decimal(1).scaleb(-digits))).cast(DecimalType(20 + digits, digits))


def percentage(part: Column, whole: Column, *, scale: int = 0, digits: int = 1) -> Column:
    """``100 * part / whole`` rounded to ``digits`` places; NULL for an empty whole."""
    share = rounded_ratio(
        part, whole, digits + 2, numerator_scale=scale, denominator_scale=scale
    )
    return (share * F.lit(Decimal(100))).cast(DecimalType(20, digits))


def mean_money(total: Column, count: Column) -> Column:
    """Unrounded mean of two-decimal amounts: 16 decimals, NULL for no amounts."""
    safe_count = F.nullif(count.cast(DecimalType(13, 0)), F.lit(0).cast(DecimalType(13, 0)))
    return total.cast(DecimalType(24, 2)) / safe_count
