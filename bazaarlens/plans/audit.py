"""Row counts of the raw tables and key checks of the stored ones."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.schemas import RAW_COLUMNS


def raw_row_counts(raw: Callable[[str], DataFrame]) -> DataFrame:
    """Rows per raw table, in name order."""
    counts = [
        raw(table).agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for table in RAW_COLUMNS
    ]
    return reduce(DataFrame.unionAll, counts).orderBy("table_name")


def column_digests(raw: Callable[[str], DataFrame]) -> DataFrame:
    """Rows, values and a digest of the values, whatever their order, per raw column.

    The digest sums the first eight hexadecimal digits of each value's MD5.
    """
    found = []
    for table, columns in RAW_COLUMNS.items():
        facts = [
            F.struct(
                F.lit(column).alias("column_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.count(column).alias("filled"),
                F.coalesce(
                    F.sum(F.conv(F.substring(F.md5(column), 1, 8), 16, 10).cast("bigint")),
                    F.lit(0).cast("bigint"),
                ).alias("digest"),
            )
            for column in columns
        ]
        row = raw(table).agg(F.array(*facts).alias("_facts"))
        found.append(row.select(F.lit(table).alias("table_name"), F.inline("_facts")))
    return reduce(DataFrame.unionAll, found)
