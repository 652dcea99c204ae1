"""The months in which somebody was active, as one bit each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Months in one word; its number stays positive.
_BITS = 60


def _number(moment: Column) -> Column:
    return F.year(moment) * 12 + F.month(moment) - 1


@dataclass(frozen=True)
class ActiveMonths:
    """One row per key: its words of bits, and whether it has rows without a moment.

    Months are counted from the first one of the table.
    """

    rows: DataFrame
    base: int
    months: int

    def has(self, month: Column) -> Column:
        """Is the key active in the month of that number? False beyond the last one."""
        place = F.pmod(month, F.lit(_BITS)).cast("int")
        word = F.get("_words", F.floor(month / _BITS).cast("int"))
        bit = F.call_function("shiftright", word, place).bitwiseAND(F.lit(1).cast("long"))
        return F.coalesce(bit == 1, F.lit(False))

    def first(self) -> Column:
        """Number of the key's first month, NULL without one: the lowest bit set."""
        found = []
        for k in range(-(-self.months // _BITS)):
            word = F.get("_words", F.lit(k))
            below = word.bitwiseAND(-word) - 1  # as many bits as are below the lowest
            found.append(F.when(word != 0, F.bit_count(below) + k * _BITS))
        return F.coalesce(*found, F.lit(None).cast("int"))

    def all(self) -> Column:
        """Numbers of the key's months, with a NULL for rows without a moment."""
        dated = F.filter(F.sequence(F.lit(0), F.lit(max(self.months - 1, 0))), self.has)
        none = F.array(F.lit(None).cast("int"))
        return F.when(F.col("_undated"), F.concat(dated, none)).otherwise(dated)

    def start(self, month: Column) -> Column:
        """First day of the month of that number."""
        number = month + self.base
        return F.make_date(F.floor(number / 12).cast("int"), F.pmod(number, F.lit(12)) + 1, F.lit(1))


def active_months(df: DataFrame, key: str, moment: str) -> ActiveMonths:
    """Bits of each key's months; rows are reduced to one per key in every task first.

    The span of months is looked up once, as a minimum and maximum, while the plan is made.
    """
    number = _number(F.col(moment))
    low, high = df.agg(F.min(number), F.max(number)).first()
    base, months = (0, 0) if low is None else (low, high - low + 1)
    place = number - base
    words = [
        F.coalesce(
            F.bit_or(
                F.when(
                    F.floor(place / _BITS) == k,
                    F.call_function(
                        "shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(_BITS)).cast("int")
                    ),
                )
            ),
            F.lit(0).cast("long"),
        )
        for k in range(-(-months // _BITS) or 1)
    ]
    rows = df.groupBy(key).agg(
        F.array(*words).alias("_words"), F.bool_or(F.col(moment).isNull()).alias("_undated")
    )
    return ActiveMonths(rows, base, months)
