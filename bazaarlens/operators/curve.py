"""A space-filling order of several columns.

Files sorted by one column hold all values of the next ones. Along a curve that takes turns
between the bits of each column's rank, every range of it is narrow in all columns: with n
files, a value of one of two columns lies in about the square root of n of them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a column's rank, and rows that are sampled for the bounds of ranks, about.
BITS, SAMPLE = 8, 100_000
_NULL = ""  # before every text


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list[str]]:
    """Values that split a sample of each column into 2**bits parts of equal rows.

    As for any range partitioning, the sample is of a fixed size and decides about the
    evenness of the parts only. Columns are SQL expressions; their values are compared as
    text, which suits codes and dates.
    """
    share = min(1.0, SAMPLE / max(1, df.count()))
    drawn = df.select(*[F.expr(c).cast("string") for c in columns]).sample(share, 11)
    rows = drawn.limit(2 * SAMPLE).collect()
    found = []
    for n in range(len(columns)):
        values = sorted((row[n] for row in rows if row[n] is not None), key=str.encode)
        parts = 1 << bits
        cuts = [values[len(values) * i // parts] for i in range(1, parts)] if values else []
        found.append(sorted(set(cuts), key=str.encode))
    return found


def _cuts(bounds: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps(bounds)), "array<string>")


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(_NULL))


def _further(cuts: Column, value: Column, at: Column, step: Column) -> Column:
    """``at`` or, if the bound there is not above the value, one ``step`` on; no bound, no step."""
    return at + F.when(F.get(cuts, at + step - 1) <= value, step).otherwise(0)


def _rank(column: Column, bounds: list[str], bits: int) -> Column:
    """How many bounds are not above a value, by halving: one step for each bit."""
    if not bounds:
        return F.lit(0).cast("long")
    cuts, value = _cuts(bounds), _text(column)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: _further(cuts, value, at, step)).cast("long")


def curve_position(columns: Sequence[str], bounds: Sequence[list[str]], bits: int = BITS) -> Column:
    """Place of a row on the curve: the highest bit of each rank, then the next ones."""
    ranks = [_rank(F.expr(c), cuts, bits) for c, cuts in zip(columns, bounds, strict=True)]
    return _turns(ranks, bounds)


def with_curve_position(
    df: DataFrame, columns: Sequence[str], bounds: Sequence[list[str]], name: str, bits: int = BITS
) -> DataFrame:
    """``df`` with the same place as a column.

    Every step of the halving is a column of its own, so Spark compiles it; a step inside a
    lambda is interpreted row by row.
    """
    placed, ranks, made = df, [], []
    for n, (column, each) in enumerate(zip(columns, bounds, strict=True)):
        if not each:
            ranks.append(F.lit(0).cast("long"))
            continue
        value, at = f"_value{n}", f"_at{n}"
        placed = placed.withColumns({value: _text(F.expr(column)), at: F.lit(0)})
        for i in reversed(range(bits)):
            further = _further(_cuts(each), F.col(value), F.col(at), F.lit(1 << i))
            placed = placed.withColumn(at, further)
        ranks.append(F.col(at).cast("long"))
        made += [value, at]
    return placed.withColumn(name, _turns(ranks, bounds)).drop(*made)


def _turns(ranks: Sequence[Column], bounds: Sequence[list[str]]) -> Column:
    # a rank that uses few of its bits would take turns with zeros only
    widths = [max(len(cuts), 1).bit_length() for cuts in bounds]
    parts: list[Column] = []
    for level in range(max(widths)):
        for rank, width in zip(ranks, widths, strict=True):
            if level < width:
                parts.append(F.shiftright(rank, width - 1 - level).bitwiseAND(F.lit(1).cast("long")))
    return reduce(lambda place, bit: F.shiftleft(place, 1).bitwiseOR(bit), parts)
