"""Exact distinct counts from bitmaps of dense numbers.

A set of ids becomes a bitmap in words of 64 bits, one row each, which are united with
``bit_or`` in every task before anything moves. What is shuffled depends on the numbers of
groups and ids, not on the rows, and several counts of one input need neither a copy of its
rows for each nor a second pass. Words of 64 bits keep the union inside a hash aggregate;
the wide bitmaps of ``bitmap_construct_agg`` would sort all rows first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType

from bazaarlens.functions.ordering import rising
from bazaarlens.operators.placement import row_numbers

_WORD_BITS = 6  # 64 bits in a word


def numbered_lists(*lists: DataFrame) -> list[DataFrame]:
    """Each list with a column ``_number``: dense numbers from 1 on, those of one list together.

    A list has a column ``id``, whose values differ, and maybe ``near``: ids are numbered in
    the order of ``near``, then ``id``, so those with one value of it share their words. All
    lists are put in order by one job.
    """
    stacked = [
        each.select(
            F.lit(n).alias("_list"),
            F.col("id").cast("string").alias("id"),
            (F.col("near") if "near" in each.columns else F.lit(None)).cast("string").alias("near"),
        )
        for n, each in enumerate(lists)
    ]
    order = [rising("_list"), rising("near"), rising("id")]
    numbers = row_numbers(reduce(DataFrame.unionByName, stacked), order, "_number")
    return [
        numbers.filter(F.col("_list") == n).select(
            "id", *(["near"] if "near" in each.columns else []), "_number"
        )
        for n, each in enumerate(lists)
    ]


def word_and_bit(number: Column) -> tuple[Column, Column]:
    """The word of a bitmap that holds a number (not negative), and its bit there."""
    number = number.cast(LongType())
    place = (number % (1 << _WORD_BITS)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast(LongType()), place)
    return F.shiftright(number, _WORD_BITS), bit


def _entry(kind: int, of: Column, word: Column, bits: Column, sums: Sequence[Column]) -> Column:
    named = (F.lit(kind).alias("_kind"), of.alias("_of"), word.alias("_word"), bits.alias("_bits"))
    return F.struct(*named, *sums)


def sums_and_distinct(
    df: DataFrame,
    group: str,
    sums: Mapping[str, str],
    sets: Mapping[str, str],
    members: tuple[str, str] | None = None,
) -> DataFrame:
    """Per group: sums of columns, and how many different numbers others hold.

    ``sums``: result name to column; ``sets``: result name to a column with a number, or an
    array of numbers (not negative, no NULL inside). One row of a group gives one row of its
    sums and one for each number, which are reduced to one row per word before the shuffle.
    Numbers should be dense, and close together where they share a group. ``members``:
    result name and column of ids that have no numbers; sums are added up per id, whose
    different values are counted.
    """
    types: dict[str, DataType] = {name: df.schema[column].dataType for name, column in sums.items()}
    none = [F.lit(None).cast(types[name]).alias(name) for name in sums]
    nothing = (F.lit(None).cast(LongType()), F.lit(None).cast(LongType()))
    nobody = F.lit(None).cast(df.schema[members[1]].dataType if members else LongType())
    of = F.col(members[1]) if members else nobody
    single = [_entry(0, of, *nothing, [F.col(c).alias(name) for name, c in sums.items()])]
    several = []

    def of_kind(kind: int) -> Callable[[Column], Column]:
        def entry(number: Column) -> Column:
            return _entry(kind, nobody, *word_and_bit(number), none)

        return entry

    for kind, column in enumerate(sets.values(), 1):
        if isinstance(df.schema[column].dataType, ArrayType):
            empty = F.array().cast(df.schema[column].dataType)
            several.append(F.transform(F.coalesce(column, empty), of_kind(kind)))
        else:  # no number, no bit
            single.append(of_kind(kind)(F.col(column)))
    entries = F.concat(F.array(*single), *several) if several else F.array(*single)
    per_word = (
        df.select(group, F.inline(entries))
        .groupBy(group, "_kind", "_of", "_word")
        .agg(*[F.sum(name).alias(name) for name in sums], F.bit_or("_bits").alias("_bits"))
    )
    counts = [
        F.coalesce(F.sum(F.when(F.col("_kind") == kind, F.bit_count("_bits"))), F.lit(0)).alias(name)
        for kind, name in enumerate(sets, 1)
    ]
    if members:
        counts.append(F.count("_of").alias(members[0]))
    return per_word.groupBy(group).agg(*[F.sum(name).alias(name) for name in sums], *counts)
